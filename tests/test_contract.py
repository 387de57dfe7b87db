"""The derived tables keep the promises the plans rest on."""

import pytest
from pyspark.sql import functions as F

from enrolmeter.sources.schema import SCHEMAS

ROWS = {
    "inscripciones": 1500, "pagos_inscripcion": 1500, "programas": 200, "postgrados": 22,
    "categorias": 11, "plan_cobros_programa": 4, "plan_pagos": 4599,
    "detalle_pagos_inscripcion": 4818, "personas": 160, "sedes": 135, "unidad_negocio": 5,
    "instituciones": 4,
}


@pytest.mark.parametrize("name", SCHEMAS)
def test_rows_types_and_unique_ids(small_tables, name):
    df = small_tables[name]
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in SCHEMAS[name]
    ]
    assert df.count() == ROWS[name]
    if name != "detalle_pagos_inscripcion":
        assert df.groupBy("id").count().where(F.col("count") > 1).isEmpty()


def test_tables_are_a_mapping_of_the_twelve(small_tables):
    assert set(small_tables) == set(SCHEMAS) and len(small_tables) == 12
    with pytest.raises(KeyError):
        small_tables["lineitem"]
