"""The twelve logical tables, their columns and Spark types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Single instalments fit 18 digits (one machine word per value in Spark's row format).
# Sums get 28: a plan line that collects a third of a very large payment table must not
# overflow, and under ANSI mode an overflow is an error, not a NULL.
AMOUNT = T.DecimalType(18, 2)
TOTAL = T.DecimalType(28, 2)

_LONG, _INT, _TEXT, _WHEN = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ACADEMIC = {
    "inscripciones": _table(
        id=_LONG, idprograma=_LONG, idestudiante=_LONG, idasesor=_LONG,
        plan_cobro_programa_id=_LONG, estado_ins=_INT, created_at=_WHEN,
    ),
    "programas": _table(
        id=_LONG, codigo=_TEXT, nombre_compuesto=_TEXT,
        idpostgrado=_LONG, idsede=_LONG, iduniversidad=_LONG,
    ),
    "postgrados": _table(id=_LONG, idcategoria=_LONG),
    "categorias": _table(id=_LONG, nombre=_TEXT),
    "plan_cobros_programa": _table(id=_LONG, nombre=_TEXT),
    "plan_pagos": _table(
        id=_LONG, inscripcion_id=_LONG, nro_cuota=_INT, concepto_pago_id=_INT,
        monto=AMOUNT, saldo=AMOUNT,
    ),
    "detalle_pagos_inscripcion": _table(
        cuota_id=_LONG, pagos_inscripcion_id=_LONG, fecha_registro_pago=_WHEN, estado=_INT,
    ),
    "pagos_inscripcion": _table(id=_LONG, nro_recibo=_LONG, estado=_INT),
}
ADMIN = {
    "personas": _table(
        id=_LONG, nombres=_TEXT, pri_apellido=_TEXT, seg_apellido=_TEXT, num_doc=_TEXT,
    ),
    "sedes": _table(id=_LONG, nombre=_TEXT, unidad_negocio=_LONG),
    "unidad_negocio": _table(id=_LONG, nombre=_TEXT),
    "instituciones": _table(id=_LONG, abreviatura=_TEXT),
}
SCHEMAS: dict[str, T.StructType] = {**ACADEMIC, **ADMIN}

#: The tables that grow with enrolments and payments.
FACTS = ("inscripciones", "plan_pagos", "detalle_pagos_inscripcion", "pagos_inscripcion")

# Columns that may be used to cut a table into ranges when reading over JDBC.
RANGE_COLUMN = {name: "id" for name in SCHEMAS} | {"detalle_pagos_inscripcion": "cuota_id"}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Keep the table's declared columns, in order, in their declared types.

    Columns that already have the type pass through untouched: filters on them reach the
    scan, and two uses of the table have equal plans, so Spark can reuse their exchanges.
    """
    stored = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *(
            f.name if stored.get(f.name) == f.dataType
            else F.expr(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}")
            for f in SCHEMAS[table].fields
        )
    )
