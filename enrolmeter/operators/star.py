"""The enrolment star: programs, sites, institutions, plans and people around enrolments.

Dimensions that hang off the program are joined to the program, not to the enrolment: the
program table is far smaller, and the enrolments then meet one prepared table once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..sources.tables import Tables


def one_of(column: str, ids: Sequence[int]) -> Column:
    """Equality for a single id, membership for several.

    Written as one SQL expression: a long list costs one call to the JVM, not one per id.
    """
    if not ids:
        raise ValueError(f"no ids for {column}: an empty list selects nothing, None stands for all")
    if len(ids) == 1:
        return F.col(column) == int(ids[0])
    return F.expr(f"{column} IN ({', '.join(str(int(i)) for i in ids)})")


def attach_category(programs: DataFrame, tables: Tables) -> DataFrame:
    """Add the program's category, reached through the postgraduate group."""
    groups = tables["postgrados"].select(
        F.col("id").alias("idpostgrado"), F.col("idcategoria").alias("ID_CATEGORIA")
    )
    categories = tables["categorias"].select(
        F.col("id").alias("ID_CATEGORIA"), F.col("nombre").alias("TIPO_PROGRAMA")
    )
    return programs.join(groups, "idpostgrado").join(categories, "ID_CATEGORIA")


def program_hierarchy(tables: Tables) -> DataFrame:
    """Programs under report names, with their category."""
    programs = tables["programas"].select(
        F.col("id").alias("ID_PROGRAMA"),
        F.col("codigo").alias("COD_CONTABLE"),
        F.col("nombre_compuesto").alias("PROGRAMA"),
        "idpostgrado",
        F.col("idsede").alias("ID_SEDE"),
        F.col("iduniversidad").alias("ID_INSTITUCION"),
    )
    return attach_category(programs, tables)


def attach_site(programs: DataFrame, tables: Tables) -> DataFrame:
    """Add site and business unit; a site without a unit keeps a NULL unit."""
    sites = tables["sedes"].select(
        F.col("id").alias("ID_SEDE"), F.col("nombre").alias("SEDE"), "unidad_negocio"
    )
    units = tables["unidad_negocio"].select(
        F.col("id").alias("unidad_negocio"), F.col("nombre").alias("UNIDAD")
    )
    return programs.join(sites, "ID_SEDE").join(units, "unidad_negocio", "left")


def attach_agreement(programs: DataFrame, tables: Tables) -> DataFrame:
    """Add the partner institution's label. ``ID_INSTITUCION`` becomes the id found there,
    so a program pointing at no known institution has none."""
    partners = tables["instituciones"].select(
        F.col("id").alias("partner"), F.col("abreviatura").alias("abreviatura")
    )
    return (
        programs.join(partners, programs["ID_INSTITUCION"] == partners["partner"], "left")
        .withColumn("CONVENIO", labels.agreement(F.col("abreviatura")))
        .drop("ID_INSTITUCION", "abreviatura")
        .withColumnRenamed("partner", "ID_INSTITUCION")
    )


def program_catalogue(
    tables: Tables,
    sites: Sequence[int] | None = None,
    institutions: Sequence[int] | None = None,
    agreement: bool = True,
) -> DataFrame:
    """Programs with every descriptive column a report shows, limited to sites and partners.

    The filters stand on the joined columns; Catalyst turns the partner join inner where
    partners are asked for, and infers both filters onto the program scan.
    """
    catalogue = attach_site(program_hierarchy(tables), tables)
    if agreement or institutions is not None:
        catalogue = attach_agreement(catalogue, tables)
    if sites is not None:
        catalogue = catalogue.where(one_of("ID_SEDE", sites))
    if institutions is not None:
        catalogue = catalogue.where(one_of("ID_INSTITUCION", institutions))
    return catalogue


def enrolment_rows(tables: Tables) -> DataFrame:
    """Enrolments under report names: fixed-width columns only, so they shuffle cheaply."""
    return tables["inscripciones"].select(
        F.col("id").alias("ID_INSCRIPCION"),
        F.col("idprograma").alias("ID_PROGRAMA"),
        "idestudiante",
        "idasesor",
        "plan_cobro_programa_id",
        "estado_ins",
        F.col("created_at").alias("fecha_creacion_inscripcion"),
    )


def attach_plan_type(enrolments: DataFrame, tables: Tables) -> DataFrame:
    """Add cash or credit from the charge plan's name."""
    plans = tables["plan_cobros_programa"].select(
        F.col("id").alias("plan_cobro_programa_id"), F.col("nombre").alias("plan_nombre")
    )
    return (
        enrolments.join(plans, "plan_cobro_programa_id", "left")
        .withColumn("TIPO_PLAN_PAGO", labels.plan_type(F.col("plan_nombre")))
        .drop("plan_nombre")
    )


def attach_people(enrolments: DataFrame, tables: Tables) -> DataFrame:
    """Add the student (required) and the adviser (optional), two roles of one table.

    Advisers repeat, so one may hold a large share of the enrolments, and so may 'none'.
    The enrolments are the preserved side of that join, which is the side adaptive
    execution may split.
    """

    def role(key: str, name: str, document: str) -> DataFrame:
        return tables["personas"].select(
            F.col("id").alias(key),
            labels.full_name(F.col("nombres"), F.col("pri_apellido"), F.col("seg_apellido")).alias(name),
            F.col("num_doc").alias(document),
        )

    joined = enrolments.join(role("idestudiante", "ALUMNO", "CI_ALUMNO"), "idestudiante").join(
        role("idasesor", "ASESOR", "CI_ASESOR"), "idasesor", "left"
    )
    # An absent adviser has an empty name, as joining no parts gives, and no document.
    return joined.withColumn("ASESOR", F.coalesce("ASESOR", F.lit("")))


def enrolment_base(
    tables: Tables,
    sites: Sequence[int] | None = None,
    institutions: Sequence[int] | None = None,
) -> DataFrame:
    """Enrolments with program, site, partner, plan and people."""
    joined = enrolment_rows(tables).join(
        program_catalogue(tables, sites, institutions), "ID_PROGRAMA"
    )
    return attach_people(attach_plan_type(joined, tables), tables)
