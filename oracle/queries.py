"""Plain SQL for every registered query. Money is cast to DOUBLE after summing, as the
entry module does on the Spark side, so that both sides compare in one type."""

from __future__ import annotations

from . import values as V
from .tables import with_tables

START, END = "1996-01-01 00:00:00", "2000-12-31 23:59:59"


def _ids(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


def _texts(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _lookup(key: str, pairs, otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN {code} THEN '{word}'" for code, word in pairs)
    return f"CASE {key} {arms} ELSE {otherwise} END"


def _between(date: str, start: str = START, end: str = END) -> str:
    return f"{date} BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"


def _state(code: str) -> str:
    return _lookup(code, enumerate(V.STATE_LABELS), f"'{V.UNIDENTIFIED}'")


def _month(date: str) -> str:
    return _lookup(f"month({date})", enumerate(V.MONTH_LABELS, 1))


def _money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def _ok(saldo: str) -> str:
    return f"coalesce({saldo}, 1) = 0"


def _yes_no(test: str) -> str:
    return f"CASE WHEN {test} THEN '{V.ENROLLED}' ELSE '{V.NOT_ENROLLED}' END"


PLAN_LABEL = (
    f"CASE WHEN upper(pl.nombre) LIKE '%{V.CASH_MARK}%' "
    f"THEN '{V.CASH_LABEL}' ELSE '{V.CREDIT_LABEL}' END"
)

# --- payments and balances, each a derived table of its own ---------------------------------

VALID_PAYMENTS = """
    SELECT pay.cuota_id, max(pay.fecha_registro_pago) AS fecha_pago,
           max(rec.nro_recibo) AS nro_recibo
    FROM detalle_pagos_inscripcion AS pay
    JOIN pagos_inscripcion AS rec ON pay.pagos_inscripcion_id = rec.id
    WHERE pay.estado = 1 AND rec.estado = 1
    GROUP BY pay.cuota_id"""

_SOURCES = {
    "dedup": """plan_pagos AS line LEFT JOIN valid_payments AS paid ON paid.cuota_id = line.id""",
    "raw": """plan_pagos AS line
              LEFT JOIN (SELECT cuota_id, fecha_registro_pago AS fecha_pago, pagos_inscripcion_id
                         FROM detalle_pagos_inscripcion WHERE estado = 1) AS pay
                     ON pay.cuota_id = line.id
              LEFT JOIN (SELECT id AS rid, nro_recibo
                         FROM pagos_inscripcion WHERE estado = 1) AS rec
                     ON rec.rid = pay.pagos_inscripcion_id""",
    "none": "plan_pagos AS line",
}


def _balance(where: str, mode: str) -> str:
    dated = "" if mode == "none" else ", max(fecha_pago) AS fecha, max(nro_recibo) AS recibo"
    return f"""SELECT line.inscripcion_id AS eid, sum(line.monto) AS monto,
        sum(line.monto - line.saldo) AS cancelado, sum(line.saldo) AS saldo{dated}
        FROM {_SOURCES[mode]} WHERE {where} GROUP BY line.inscripcion_id"""


def _balance_by_value(where: str, mode: str) -> str:
    return f"""SELECT line.inscripcion_id AS eid, line.monto, line.saldo,
        max(fecha_pago) AS fecha, max(nro_recibo) AS recibo
        FROM {_SOURCES[mode]} WHERE {where} GROUP BY line.inscripcion_id, line.monto, line.saldo"""


def _concept(*concepts: int, first: bool = False) -> str:
    test = f"line.concepto_pago_id IN {_ids(concepts)}"
    return f"{test} AND line.nro_cuota = 1" if first else test


ALL_LINES = "line.id IS NOT NULL"

# --- the star ------------------------------------------------------------------------------

STAR = f"""
    SELECT e.id AS eid, e.estado_ins, e.created_at,
           prog.id AS pid, prog.codigo, prog.nombre_compuesto,
           cat.id AS cat_id, cat.nombre AS cat_nombre,
           site.id AS site_id, site.nombre AS sede, unit.nombre AS unidad,
           partner.id AS partner_id, coalesce(partner.abreviatura, '{V.NO_AGREEMENT_LABEL}') AS convenio,
           {PLAN_LABEL} AS plan_label,
           concat_ws(' ', adv.nombres, adv.pri_apellido, adv.seg_apellido) AS asesor,
           adv.num_doc AS ci_asesor,
           concat_ws(' ', stu.nombres, stu.pri_apellido, stu.seg_apellido) AS alumno,
           stu.num_doc AS ci_alumno
    FROM inscripciones AS e
    JOIN programas AS prog ON e.idprograma = prog.id
    JOIN postgrados AS grp ON prog.idpostgrado = grp.id
    JOIN categorias AS cat ON grp.idcategoria = cat.id
    JOIN sedes AS site ON prog.idsede = site.id
    JOIN personas AS stu ON e.idestudiante = stu.id
    LEFT JOIN personas AS adv ON e.idasesor = adv.id
    LEFT JOIN plan_cobros_programa AS pl ON e.plan_cobro_programa_id = pl.id
    LEFT JOIN unidad_negocio AS unit ON site.unidad_negocio = unit.id
    LEFT JOIN instituciones AS partner ON prog.iduniversidad = partner.id"""

HEAD = """unidad AS UNIDAD, sede AS SEDE, asesor AS ASESOR, ci_asesor AS CI_ASESOR,
    alumno AS ALUMNO, ci_alumno AS CI_ALUMNO, cat_nombre AS TIPO_PROGRAMA,
    star.eid AS ID_INSCRIPCION, codigo AS COD_CONTABLE, nombre_compuesto AS PROGRAMA,
    pid AS ID_PROGRAMA"""

PLAN, COURSE, AGREEMENT = "plan_label AS TIPO_PLAN_PAGO", "es_curso", "convenio AS CONVENIO"


class Unit:
    """One report: derived balances, the rules over them, and the columns shown."""

    def __init__(self, balances, date, condition, where, money, plan=True, course=None,
                 agreement=True, created=False, order="ID_INSCRIPCION"):
        self.balances, self.date, self.condition, self.where = balances, date, condition, where
        self.money, self.plan, self.course = money, plan, course
        self.agreement, self.created, self.order = agreement, created, order

    def _joins(self) -> str:
        return " ".join(f"LEFT JOIN {b} ON {b}.eid = star.eid" for b in self.balances)

    def _derived(self, dedup: bool) -> dict[str, str]:
        built = {"valid_payments": VALID_PAYMENTS} if self.uses_valid(dedup) else {}
        for name, (build, where, mode) in self.balances.items():
            built[name] = build(where, "dedup" if dedup and mode == "raw" else mode)
        return built | {"star": STAR}

    def uses_valid(self, dedup: bool) -> bool:
        modes = {mode for _, _, mode in self.balances.values()}
        return "dedup" in modes or (dedup and "raw" in modes)

    def report(self, dedup: bool = False) -> str:
        shown = [HEAD]
        if self.plan:
            shown.append(PLAN)
        if self.course:
            shown.append(f"{self.course} AS ES_CURSO")
        shown += [f"{_money(f'coalesce({expr}, 0)')} AS {name}" for name, expr in self.money.items()]
        shown += [
            f"{self.date} AS FECHA_PAGO_DECISIVA",
            f"{self.condition} AS CONDICION_INSCRITO",
            f"{_state('estado_ins')} AS ESTADO_INSCRIPCION",
        ]
        if self.agreement:
            shown.append(AGREEMENT)
        shown.append(f"{_month(self.date)} AS MES")
        if self.created:
            shown.append("created_at AS fecha_creacion_inscripcion")
        body = (
            f"SELECT {', '.join(shown)} FROM star {self._joins()} "
            f"WHERE {self.where} AND {_between(self.date)} ORDER BY {self.order}"
        )
        return with_tables(body, **self._derived(dedup))

    def rated(self, columns: str, where: str = "TRUE") -> str:
        """The rules over the enrolments of every site, with balances or without."""
        body = (
            f"SELECT star.eid AS ID_INSCRIPCION, {columns} FROM star {self._joins()} "
            f"WHERE {where}"
        )
        return with_tables(body, **self._derived(False))

    def show_date(self) -> str:
        return f"{self.date} AS FECHA_PAGO_DECISIVA"

    def show_condition(self) -> str:
        return f"{self.condition} AS CONDICION_INSCRITO"


_IS_NAMED_COURSE = f"cat_nombre IN {_texts(V.COURSE_CATEGORY_NAMES)}"
_IS_CASH = f"plan_label = '{V.CASH_LABEL}'"
_IS_CAREER_COURSE = f"cat_id IN {_ids(V.CAREER_COURSE_CATEGORIES)}"
_IS_KIDS_COURSE = f"cat_id IN {_ids(V.KIDS_COURSE_CATEGORIES)}"
_IS_KIDS_MONTHLY = f"cat_id IN {_ids(V.KIDS_MONTHLY_CATEGORIES)}"
_IS_TITLED_COURSE = f"upper(nombre_compuesto) LIKE '%{V.COURSE_MARK}%'"


def _flag(test: str) -> str:
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


POSTGRADUATE = Unit(
    balances={
        "fee": (_balance, _concept(1), "raw"),
        "tuition": (_balance_by_value, _concept(2, first=True), "raw"),
        "whole": (_balance, ALL_LINES, "raw"),
    },
    date=f"""CASE WHEN {_IS_NAMED_COURSE} THEN whole.fecha
                  WHEN {_IS_CASH} OR tuition.fecha IS NOT NULL THEN tuition.fecha
                  ELSE fee.fecha END""",
    condition=f"""CASE WHEN {_IS_NAMED_COURSE} THEN {_yes_no(_ok('whole.saldo'))}
                       WHEN {_IS_CASH} THEN {_yes_no(_ok('tuition.saldo'))}
                       ELSE {_yes_no(_ok('fee.saldo') + ' AND ' + _ok('tuition.saldo'))} END""",
    where=f"site_id IN {_ids(V.POSTGRADUATE_SITES)} AND partner_id = 9",
    money={
        "MONTO_MATRICULA": "fee.monto", "SALDO_MATRICULA": "fee.saldo",
        "MONTO_COLEGIATURA_CUOTA1": "tuition.monto", "SALDO_COLEGIATURA_CUOTA1": "tuition.saldo",
        "MONTO_TOTAL_PLAN": "whole.monto", "SALDO_TOTAL_PLAN": "whole.saldo",
    },
    course=_flag(_IS_NAMED_COURSE),
    created=True,
    order="tuition.fecha NULLS FIRST, ID_INSCRIPCION, tuition.monto NULLS FIRST, "
    "tuition.saldo NULLS FIRST",
)

INITIAL_FEE = Unit(
    balances={
        "opening": (_balance, _concept(133, first=True), "dedup"),
        "tuition": (_balance, _concept(2, first=True), "dedup"),
        "whole": (_balance, ALL_LINES, "none"),
    },
    date=f"""CASE WHEN {_ok('opening.saldo')} AND {_ok('tuition.saldo')}
                       AND opening.fecha <= tuition.fecha THEN opening.fecha
                  WHEN {_ok('tuition.saldo')} THEN tuition.fecha
                  WHEN {_ok('opening.saldo')} THEN opening.fecha
                  ELSE coalesce(opening.fecha, tuition.fecha) END""",
    condition=_yes_no(f"{_ok('opening.saldo')} OR {_ok('tuition.saldo')}"),
    where=f"site_id IN {_ids(V.INITIAL_FEE_SITES)} AND partner_id = 49",
    money={
        "MONTO_CUOTA_INICIAL": "opening.monto",
        "CANCELADO_CUOTA_INICIAL": "opening.cancelado",
        "SALDO_CUOTA_INICIAL": "opening.saldo",
        "MONTO_COLEGIATURA_INICIAL": "tuition.monto",
        "CANCELADO_COLEGIATURA_INICIAL": "tuition.cancelado",
        "SALDO_COLEGIATURA_INICIAL": "tuition.saldo",
        "MONTO_TOTAL": "whole.monto",
        "CANCELADO_TOTAL": "whole.cancelado",
        "SALDO_TOTAL": "whole.saldo",
    },
)

_ENTRY_DATE = "coalesce(tuition.fecha, part_fee.fecha)"
PARTNER_UNIVERSITIES = Unit(
    balances={
        "fee": (_balance, _concept(1), "raw"),
        "tuition": (_balance, _concept(2, first=True), "raw"),
        "part_fee": (_balance, _concept(312, first=True), "raw"),
        "whole": (_balance, ALL_LINES, "none"),
    },
    date=f"""CASE WHEN fee.fecha IS NULL THEN {_ENTRY_DATE}
                  WHEN {_ENTRY_DATE} IS NULL THEN fee.fecha
                  WHEN fee.fecha >= {_ENTRY_DATE} THEN fee.fecha
                  ELSE {_ENTRY_DATE} END""",
    condition=_yes_no(
        "(fee.saldo IS NULL OR fee.saldo = 0) AND (tuition.saldo = 0 "
        "OR (tuition.saldo IS NULL AND part_fee.saldo = 0))"
    ),
    where=(
        f"site_id IN {_ids(V.PARTNER_SITES)} AND partner_id IN (301, 307)"
    ),
    money={
        "MONTO_MATRICULA": "fee.monto", "SALDO_MATRICULA": "fee.saldo",
        "MONTO_COLEGIATURA1": "tuition.monto", "SALDO_COLEGIATURA1": "tuition.saldo",
        "MONTO_CUOTA1": "part_fee.monto", "SALDO_CUOTA1": "part_fee.saldo",
        "MONTO_TOTAL_PLAN": "whole.monto", "SALDO_TOTAL_PLAN": "whole.saldo",
    },
)

INSTITUTE = Unit(
    balances={"monthly": (_balance, _concept(27, first=True), "dedup")},
    date="monthly.fecha",
    condition=_yes_no(_ok("monthly.saldo")),
    where="site_id = 49",
    money={
        "MONTO_MENSUALIDAD_CUOTA1": "monthly.monto",
        "CANCELADO_MENSUALIDAD_CUOTA1": "monthly.cancelado",
        "SALDO_MENSUALIDAD_CUOTA1": "monthly.saldo",
    },
)

CAREERS = Unit(
    balances={
        "monthly": (_balance, _concept(8, first=True), "raw"),
        "whole": (_balance, _concept(8, 17), "raw"),
    },
    date=f"CASE WHEN {_IS_CAREER_COURSE} THEN whole.fecha ELSE monthly.fecha END",
    condition=f"""CASE WHEN {_IS_CAREER_COURSE} THEN {_yes_no(_ok('whole.saldo'))}
                       ELSE {_yes_no(_ok('monthly.saldo'))} END""",
    where=f"site_id IN {_ids(V.CAREER_SITES)}",
    money={
        "MONTO_MENSUALIDAD_CUOTA1": "monthly.monto", "SALDO_MENSUALIDAD_CUOTA1": "monthly.saldo",
        "MONTO_TOTAL_PLAN": "whole.monto", "SALDO_TOTAL_PLAN": "whole.saldo",
    },
    plan=False,
    course=_flag(_IS_CAREER_COURSE),
)

KIDS = Unit(
    balances={
        "monthly": (_balance, _concept(27, first=True), "dedup"),
        "courses": (_balance, _concept(311), "dedup"),
    },
    date=f"""CASE WHEN {_IS_KIDS_COURSE} THEN courses.fecha
                  WHEN {_IS_KIDS_MONTHLY} THEN monthly.fecha END""",
    condition=f"""CASE WHEN {_IS_KIDS_COURSE} THEN {_yes_no(_ok('courses.saldo'))}
                       WHEN {_IS_KIDS_MONTHLY} THEN {_yes_no(_ok('monthly.saldo'))}
                       ELSE '{V.UNIDENTIFIED}' END""",
    where=f"site_id IN {_ids(V.KIDS_SITES)}",
    money={
        "MONTO_MENSUALIDAD_CUOTA1": "monthly.monto",
        "CANCELADO_MENSUALIDAD_CUOTA1": "monthly.cancelado",
        "SALDO_MENSUALIDAD_CUOTA1": "monthly.saldo",
        "MONTO_TOTAL_PLAN": "courses.monto",
        "CANCELADO_TOTAL_PLAN": "courses.cancelado",
        "SALDO_TOTAL_PLAN": "courses.saldo",
    },
    course=_flag(_IS_KIDS_COURSE),
    agreement=False,
)

TECHNICAL = Unit(
    balances={
        "monthly": (_balance, _concept(8, first=True), "dedup"),
        "course": (_balance, _concept(18, first=True), "dedup"),
    },
    date=f"CASE WHEN {_IS_TITLED_COURSE} THEN course.fecha ELSE monthly.fecha END",
    condition=f"""CASE WHEN {_IS_TITLED_COURSE} THEN {_yes_no(_ok('course.saldo'))}
                       ELSE {_yes_no(_ok('monthly.saldo'))} END""",
    where="site_id = 39",
    money={
        "MONTO_MENSUALIDAD_CUOTA1": "monthly.monto",
        "CANCELADO_MENSUALIDAD_CUOTA1": "monthly.cancelado",
        "SALDO_MENSUALIDAD_CUOTA1": "monthly.saldo",
        "MONTO_CURSO_CUOTA1": "course.monto",
        "CANCELADO_CURSO_CUOTA1": "course.cancelado",
        "SALDO_CURSO_CUOTA1": "course.saldo",
    },
    plan=False,
    course=_flag(_IS_TITLED_COURSE),
    agreement=False,
)

SHORT_COURSES = Unit(
    balances={"course": (_balance, _concept(18), "raw")},
    date="course.fecha",
    condition=_yes_no(_ok("course.saldo")),
    where=f"site_id IN {_ids(V.SHORT_COURSE_SITES)}",
    money={
        "MONTO_TOTAL": "course.monto",
        "MONTO_CANCELADO": "course.cancelado",
        "SALDO": "course.saldo",
    },
    plan=False,
)

UNITS = {
    "postgraduate": POSTGRADUATE,
    "initial_fee": INITIAL_FEE,
    "partner_universities": PARTNER_UNIVERSITIES,
    "institute": INSTITUTE,
    "careers": CAREERS,
    "kids": KIDS,
    "technical": TECHNICAL,
    "short_courses": SHORT_COURSES,
}


# --- operators -----------------------------------------------------------------------------


def _one_balance(name: str, where: str, mode: str, *shown: str, build=_balance) -> str:
    columns = ["eid AS inscripcion_id"]
    for column in shown:
        value = column if column in ("fecha", "recibo") else _money(column)
        columns.append(f"{value} AS {name}_{column}")
    derived = {"valid_payments": VALID_PAYMENTS} if mode == "dedup" else {}
    return with_tables(
        f"SELECT {', '.join(columns)} FROM balance", **derived, balance=build(where, mode)
    )


def _enrolments_with(columns: str, **balances: str) -> str:
    derived = {"valid_payments": VALID_PAYMENTS} if "valid_payments" in str(balances) else {}
    joins = " ".join(f"LEFT JOIN {b} ON {b}.eid = e.id" for b in balances)
    return with_tables(
        f"SELECT e.id AS ID_INSCRIPCION, {columns} FROM inscripciones AS e {joins}",
        **derived,
        **balances,
    )


def _programs(columns: str, joins: str) -> str:
    return with_tables(f"SELECT {columns} FROM programas AS prog {joins}")


_CATEGORY = """JOIN postgrados AS grp ON prog.idpostgrado = grp.id
               JOIN categorias AS cat ON grp.idcategoria = cat.id"""
_SITE = """JOIN sedes AS site ON prog.idsede = site.id
           LEFT JOIN unidad_negocio AS unit ON site.unidad_negocio = unit.id"""
_PARTNER = "LEFT JOIN instituciones AS partner ON prog.iduniversidad = partner.id"
_LABEL = f"coalesce(partner.abreviatura, '{V.NO_AGREEMENT_LABEL}') AS CONVENIO"
_MEASURES = ("monto", "cancelado", "saldo")


def _filtered(where: str) -> str:
    return with_tables(
        f"""SELECT e.id AS ID_INSCRIPCION, prog.id AS ID_PROGRAMA, site.id AS ID_SEDE,
                   site.nombre AS SEDE, partner.id AS ID_INSTITUCION, {_LABEL}
            FROM inscripciones AS e JOIN programas AS prog ON e.idprograma = prog.id
            {_CATEGORY} {_SITE} {_PARTNER} WHERE {where}"""
    )


def oracle_queries() -> dict[str, str]:
    out = {
        "scan_enrolments": with_tables("SELECT * FROM inscripciones"),
        "program_hierarchy": with_tables(
            f"""SELECT e.id AS ID_INSCRIPCION, prog.id AS ID_PROGRAMA, codigo AS COD_CONTABLE,
                       nombre_compuesto AS PROGRAMA, cat.id AS ID_CATEGORIA,
                       cat.nombre AS TIPO_PROGRAMA
                FROM inscripciones AS e JOIN programas AS prog ON e.idprograma = prog.id {_CATEGORY}"""
        ),
        "site_unit": _programs(
            "prog.id AS ID_PROGRAMA, site.id AS ID_SEDE, site.nombre AS SEDE, unit.nombre AS UNIDAD",
            _CATEGORY + " " + _SITE,
        ),
        "agreement_label": _programs(
            f"prog.id AS ID_PROGRAMA, partner.id AS ID_INSTITUCION, {_LABEL}",
            _CATEGORY + " " + _PARTNER,
        ),
        "plan_type": with_tables(
            f"""SELECT e.id AS ID_INSCRIPCION, {PLAN_LABEL} AS TIPO_PLAN_PAGO
                FROM inscripciones AS e
                LEFT JOIN plan_cobros_programa AS pl ON e.plan_cobro_programa_id = pl.id"""
        ),
        "person_roles": with_tables(
            """SELECT e.id AS ID_INSCRIPCION,
                      concat_ws(' ', stu.nombres, stu.pri_apellido, stu.seg_apellido) AS ALUMNO,
                      stu.num_doc AS CI_ALUMNO,
                      concat_ws(' ', adv.nombres, adv.pri_apellido, adv.seg_apellido) AS ASESOR,
                      adv.num_doc AS CI_ASESOR
               FROM inscripciones AS e JOIN personas AS stu ON e.idestudiante = stu.id
               LEFT JOIN personas AS adv ON e.idasesor = adv.id"""
        ),
        "full_name": with_tables(
            """SELECT id, concat_ws(' ', nombres, pri_apellido, seg_apellido) AS NOMBRE_COMPLETO
               FROM personas"""
        ),
        "enrolment_base": with_tables(
            f"""SELECT {HEAD}, {PLAN}, {AGREEMENT}, estado_ins,
                       created_at AS fecha_creacion_inscripcion FROM star""",
            star=STAR,
        ),
        "filter_sites": _filtered(f"site.id IN {_ids(V.SHORT_COURSE_SITES)}"),
        "filter_single_site": _filtered("site.id = 39"),
        "filter_institution": _filtered("partner.id = 49"),
        "filter_institution_list": _filtered("partner.id IN (301, 307)"),
        "payments_info": with_tables(
            "SELECT cuota_id, fecha_pago, nro_recibo FROM valid_payments",
            valid_payments=VALID_PAYMENTS,
        ),
        "concept_balance": _one_balance(
            "inicial", _concept(133, first=True), "dedup", *_MEASURES, "fecha", "recibo"
        ),
        "concept_balance_all_quotas": _one_balance(
            "cursos", _concept(311), "dedup", *_MEASURES, "fecha"
        ),
        "concept_balance_raw": _one_balance(
            "matricula", _concept(1), "raw", *_MEASURES, "fecha", "recibo"
        ),
        "concept_balance_multi": _one_balance(
            "plan", _concept(8, 17), "raw", *_MEASURES, "fecha"
        ),
        "concept_balance_by_value": _one_balance(
            "colegiatura", _concept(2, first=True), "raw", "monto", "saldo", "fecha", "recibo",
            build=_balance_by_value,
        ),
        "plan_total": _one_balance("plan", ALL_LINES, "none", *_MEASURES),
        "plan_total_raw": _one_balance("plan", ALL_LINES, "raw", *_MEASURES, "fecha"),
        "collected_amount": _one_balance("curso", _concept(18), "raw", *_MEASURES),
        "receipt_void_semantics": with_tables(
            """SELECT r.eid AS inscripcion_id, r.fecha AS raw_fecha, r.recibo AS raw_recibo,
                      d.fecha AS dedup_fecha, d.recibo AS dedup_recibo
               FROM as_they_are AS r JOIN collapsed AS d ON r.eid = d.eid""",
            valid_payments=VALID_PAYMENTS,
            as_they_are=_balance(_concept(18), "raw"),
            collapsed=_balance(_concept(18), "dedup"),
        ),
        "enrolment_balances": _enrolments_with(
            ", ".join(
                f"{_money(f'{b}.{m}')} AS {name}_{m}"
                for b, name in (("fee", "matricula"), ("tuition", "colegiatura"),
                                ("part_fee", "cuota"), ("whole", "plan"))
                for m in ("monto", "saldo")
            )
            + ", fee.fecha AS matricula_fecha, tuition.fecha AS colegiatura_fecha, "
            "part_fee.fecha AS cuota_fecha",
            fee=_balance(_concept(1), "raw"),
            tuition=_balance(_concept(2, first=True), "raw"),
            part_fee=_balance(_concept(312, first=True), "raw"),
            whole=_balance(ALL_LINES, "none"),
        ),
        "null_default_money": _enrolments_with(
            ", ".join(f"{_money(f'coalesce(opening.{m}, 0)')} AS {m.upper()}" for m in _MEASURES),
            opening=_balance(_concept(133, first=True), "dedup"),
        ),
        "settled_flag": _enrolments_with(
            f"{_flag(_ok('opening.saldo'))} AS SALDADO",
            opening=_balance(_concept(133, first=True), "dedup"),
        ),
        "settled_or_absent_flag": _enrolments_with(
            f"{_flag('fee.saldo IS NULL OR fee.saldo = 0')} AS SALDADO_O_SIN_PLAN",
            fee=_balance(_concept(1), "raw"),
        ),
        "like_contains": _programs("id, nombre_compuesto", f"WHERE {_IS_TITLED_COURSE}"),
        "is_course_by_name": _programs(
            f"""prog.id AS ID_PROGRAMA, cat.nombre AS TIPO_PROGRAMA,
                {_flag(f'cat.nombre IN {_texts(V.COURSE_CATEGORY_NAMES)}')} AS ES_CURSO""",
            _CATEGORY,
        ),
        "is_course_by_id": _programs(
            f"""prog.id AS ID_PROGRAMA, cat.id AS ID_CATEGORIA,
                {_flag(f'cat.id IN {_ids(V.CAREER_COURSE_CATEGORIES)}')} AS ES_CURSO_CARRERA,
                {_flag(f'cat.id IN {_ids(V.KIDS_COURSE_CATEGORIES)}')} AS ES_CURSO_INFANTIL""",
            _CATEGORY,
        ),
        "is_course_by_title": _programs(
            f"id, nombre_compuesto, {_flag(_IS_TITLED_COURSE)} AS ES_CURSO", ""
        ),
        "state_decode": with_tables(
            f"SELECT id, {_state('estado_ins')} AS ESTADO_INSCRIPCION FROM inscripciones"
        ),
        "month_name": with_tables(f"SELECT id, {_month('created_at')} AS MES FROM inscripciones"),
        "date_rule_fallback": POSTGRADUATE.rated(
            f"{POSTGRADUATE.course} AS ES_CURSO, {PLAN}, "
            f"{_money('tuition.monto')} AS colegiatura_monto, "
            f"{_money('tuition.saldo')} AS colegiatura_saldo, {POSTGRADUATE.show_date()}"
        ),
        "date_rule_earliest": INITIAL_FEE.rated(
            "opening.fecha AS inicial_fecha, tuition.fecha AS colegiatura_fecha, "
            + INITIAL_FEE.show_date()
        ),
        "date_rule_latest": PARTNER_UNIVERSITIES.rated(PARTNER_UNIVERSITIES.show_date()),
        "date_rule_by_flag": CAREERS.rated(
            f"{CAREERS.course} AS ES_CURSO, {CAREERS.show_date()}, {CAREERS.show_condition()}"
        ),
        "date_rule_by_category": KIDS.rated(
            f"cat_id AS ID_CATEGORIA, {KIDS.show_date()}, {KIDS.show_condition()}"
        ),
        "condition_by_product": POSTGRADUATE.rated(
            f"{POSTGRADUATE.course} AS ES_CURSO, {PLAN}, {POSTGRADUATE.show_condition()}"
        ),
        "condition_or": INITIAL_FEE.rated(
            f"{_money('opening.saldo')} AS inicial_saldo, "
            f"{_money('tuition.saldo')} AS colegiatura_saldo, {INITIAL_FEE.show_condition()}"
        ),
        "condition_and": PARTNER_UNIVERSITIES.rated(
            f"{_money('fee.saldo')} AS matricula_saldo, "
            f"{_money('tuition.saldo')} AS colegiatura_saldo, "
            f"{_money('part_fee.saldo')} AS cuota_saldo, {PARTNER_UNIVERSITIES.show_condition()}"
        ),
        "period_filter_computed": INITIAL_FEE.rated(
            INITIAL_FEE.show_date(), _between(INITIAL_FEE.date)
        ),
        "period_filter_open": SHORT_COURSES.rated(
            SHORT_COURSES.show_date(), _between("course.fecha", START, "1998-06-30 12:00:00")
        ),
        "period_filter_fixed": INSTITUTE.rated(
            INSTITUTE.show_date(),
            _between("monthly.fecha", "1996-07-01 00:00:00", "1996-12-31 23:59:59"),
        ),
    }
    for name, unit in UNITS.items():
        out[f"report_{name}"] = unit.report()
        if any(mode == "raw" for _, _, mode in unit.balances.values()):
            out[f"report_{name}_dedup"] = unit.report(dedup=True)
    return out
