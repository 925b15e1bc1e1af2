"""Declared table schemas, retyping and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


LONG, INT, TEXT, DATE, TIME = LongType(), IntegerType(), StringType(), DateType(), TimestampType()
PERCENT, KILOS, INDEX, DEGREE = DecimalType(5, 2), DecimalType(8, 0), DecimalType(4, 0), DecimalType(4, 1)


def declared(*groups: tuple[str, DataType]) -> StructType:
    """Schema from groups of column names that share a type."""
    return StructType([StructField(name, kind) for names, kind in groups for name in names.split()])


# Table and column names and declared types of the data model.
SCHEMAS: dict[str, StructType] = {
    "AIDACTIEL": declared(
        ("ACTIEL ACTIELINT ABREV_INTERBULL ACTIELTYPE", TEXT),
        ("DMG LAIT_MIN LAIT_MAX", INT),
        ("PC_MG_MIN PC_MG_MAX PC_PROT_MIN PC_PROT_MAX", PERCENT),
    ),
    "CL_AIDE_ETAPE_CTRL": declared(("CD_ETAPE_CTRL", INT)),
    "CL_AIDE_TYPE_CTRL": declared(("CD_TYPE_CTRL", INT)),
    "EXPLOITATION": declared(("NOINTEXPL", LONG), ("CODPOST", INT)),
    "IDENTANV": declared(
        ("NOAN", LONG), ("SEXEAN", TEXT), ("DTNAISANINV", INT), ("NOINTSANIT", LONG), ("ACTIEL", TEXT),
        ("NOANPERE NOANMERE", LONG),
    ),
    "CL_LAITEXPL": declared(
        ("ID_LAITEXPL NOINTEXPL", LONG), ("DATE_CTRL", DATE), ("TRAIT1", TEXT), ("CD_TYPE_CTRL", INT),
        ("DATE_RECEPT_ANALYSE", DATE), ("CD_ETAPE_CTRL", INT),
    ),
    "CL_LAITLACT": declared(
        ("ID_LAITLACT NOAN", LONG), ("NOLACT", INT), ("DATE_VEL DATE_TAR", DATE),
        ("LAIT MG PROT LAIT305 MG305 PROT305 LAIT365 MG365 PROT365", KILOS),
        ("PIC", INDEX), ("PERSISTANCE", DEGREE),
    ),
    "CL_LAITCTRL": declared(
        ("ID_LAITCTRL ID_LAITEXPL ID_LAITLACT", LONG),
        ("HEURE_PREC2_DEB HEURE_PREC2_FIN HEURE_PREC_DEB HEURE_PREC_FIN HEURE_TRAIT1_DEB HEURE_TRAIT1_FIN", TIME),
        ("LAIT_TRAIT1 LAIT_TRAIT2 LAIT_24_OBS", INT),
        ("POURC_PROT_24_OBS POURC_MG_24_OBS", PERCENT),
        ("CELL_24_OBS UREE_24_OBS LAIT_24_VAL", INT),
        ("POURC_PROT_24_VAL POURC_MG_24_VAL", PERCENT),
        ("CELL_24_VAL UREE_24_VAL LAIT_24_PREVU", INT),
    ),
}

# The declared keys.
PRIMARY_KEYS = {
    "AIDACTIEL": ["ACTIEL"],
    "CL_AIDE_ETAPE_CTRL": ["CD_ETAPE_CTRL"],
    "CL_AIDE_TYPE_CTRL": ["CD_TYPE_CTRL"],
    "EXPLOITATION": ["NOINTEXPL"],
    "IDENTANV": ["NOAN"],
    "CL_LAITEXPL": ["ID_LAITEXPL"],
    "CL_LAITLACT": ["ID_LAITLACT"],
    "CL_LAITCTRL": ["ID_LAITCTRL"],
}
FOREIGN_KEYS = [
    ("IDENTANV", "NOINTSANIT", "EXPLOITATION", "NOINTEXPL"),
    ("IDENTANV", "ACTIEL", "AIDACTIEL", "ACTIEL"),
    ("CL_LAITEXPL", "NOINTEXPL", "EXPLOITATION", "NOINTEXPL"),
    ("CL_LAITEXPL", "CD_TYPE_CTRL", "CL_AIDE_TYPE_CTRL", "CD_TYPE_CTRL"),
    ("CL_LAITEXPL", "CD_ETAPE_CTRL", "CL_AIDE_ETAPE_CTRL", "CD_ETAPE_CTRL"),
    ("CL_LAITLACT", "NOAN", "IDENTANV", "NOAN"),
    ("CL_LAITCTRL", "ID_LAITEXPL", "CL_LAITEXPL", "ID_LAITEXPL"),
    ("CL_LAITCTRL", "ID_LAITLACT", "CL_LAITLACT", "ID_LAITLACT"),
]


def enforce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, cast and in its order; absent ones are NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def conform_to(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the structure of another table."""
    return enforce_schema(df, like.schema)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_refs(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Non-NULL child keys without a parent row, with the number ``n`` of rows that hold them.

    The child is counted per key before the join, so a hot key costs one row.
    """
    used = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("_parent"))
    return used.join(known, F.col(child_key) == F.col("_parent"), "left_anti")
