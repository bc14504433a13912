"""The eight credit tables: schemas, scans and cleaning at the scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import nan_to_null, sentinel_to_null


@dataclass(frozen=True)
class TableSpec:
    """File name and column types (all nullable) of one input table."""

    file: str
    ddl: str
    extra_sentinels: tuple[tuple[str, str], ...] = ()


_DOCUMENT_FLAGS = ", ".join(f"FLAG_DOCUMENT_{i} int" for i in range(2, 11))

_APPLICATION = f"""
SK_ID_CURR long, TARGET int,
AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double,
CNT_FAM_MEMBERS double,
DAYS_BIRTH int, DAYS_EMPLOYED int, DAYS_REGISTRATION double, DAYS_ID_PUBLISH int,
DAYS_LAST_PHONE_CHANGE double,
EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double,
DEF_30_CNT_SOCIAL_CIRCLE double, DEF_60_CNT_SOCIAL_CIRCLE double, OBS_30_CNT_SOCIAL_CIRCLE double,
REGION_RATING_CLIENT int, REGION_RATING_CLIENT_W_CITY int,
{_DOCUMENT_FLAGS},
FLAG_MOBIL int, FLAG_EMP_PHONE int, FLAG_WORK_PHONE int, FLAG_CONT_MOBILE int, FLAG_PHONE int,
FLAG_EMAIL int,
CNT_CHILDREN int, OWN_CAR_AGE double, OCCUPATION_TYPE string, CODE_GENDER string
"""

TABLES: dict[str, TableSpec] = {
    "application_train": TableSpec(
        "application_train.csv", _APPLICATION, (("CODE_GENDER", "XNA"),)
    ),
    "application_test": TableSpec(
        "application_test.csv", _APPLICATION.replace("TARGET int,", ""), (("CODE_GENDER", "XNA"),)
    ),
    "bureau": TableSpec(
        "bureau.csv",
        "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_DAY_OVERDUE int,"
        " DAYS_CREDIT int, DAYS_CREDIT_ENDDATE double, AMT_CREDIT_SUM double,"
        " AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_OVERDUE double, CNT_CREDIT_PROLONG int",
    ),
    "bureau_balance": TableSpec(
        "bureau_balance.csv", "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string"
    ),
    "previous_application": TableSpec(
        "previous_application.csv",
        "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, AMT_APPLICATION double,"
        " AMT_CREDIT double, AMT_ANNUITY double, AMT_DOWN_PAYMENT double, AMT_GOODS_PRICE double,"
        " CNT_PAYMENT double, DAYS_DECISION int, DAYS_FIRST_DRAWING double, DAYS_FIRST_DUE double,"
        " DAYS_LAST_DUE_1ST_VERSION double, DAYS_LAST_DUE double, DAYS_TERMINATION double",
    ),
    "installments_payments": TableSpec(
        "installments_payments.csv",
        "SK_ID_CURR long, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT double,"
        " DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
    ),
    "pos_cash_balance": TableSpec(
        "POS_CASH_balance.csv",
        "SK_ID_CURR long, MONTHS_BALANCE int, SK_DPD int, SK_DPD_DEF int,"
        " NAME_CONTRACT_STATUS string, CNT_INSTALMENT double, CNT_INSTALMENT_FUTURE double",
    ),
    "credit_card_balance": TableSpec(
        "credit_card_balance.csv",
        "SK_ID_CURR long, MONTHS_BALANCE int, SK_DPD int, AMT_BALANCE double,"
        " AMT_CREDIT_LIMIT_ACTUAL double, AMT_PAYMENT_CURRENT double,"
        " AMT_INST_MIN_REGULARITY double, AMT_DRAWINGS_ATM_CURRENT double,"
        " AMT_DRAWINGS_CURRENT double, AMT_DRAWINGS_OTHER_CURRENT double,"
        " AMT_DRAWINGS_POS_CURRENT double",
    ),
}


# The spellings of a missing value in a text column.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _known(name: str) -> Column:
    """The text of a column, NULL where it spells a missing value."""
    return F.when(~F.col(f"`{name}`").isin(*MISSING), F.col(f"`{name}`"))


def _whole(text: Column) -> Column:
    """A whole number, also when written with a decimal point; NULL for anything else."""
    exact = text.try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact).try_cast("bigint")


def _typed(name: str, kind: T.DataType) -> Column:
    """The text as ``kind``; a value that does not fit stops the job and is named."""
    text = _known(name)
    if isinstance(kind, T.StringType):
        return text.alias(name)
    if isinstance(kind, WHOLE):
        value = _whole(text).try_cast(kind)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(text.rlike(NUMBER), F.trim(text).try_cast(kind))
    else:
        value = text.try_cast(kind)
    problem = F.concat(F.lit(f"{name} does not hold {kind.simpleString()}: "), text)
    return (
        F.when(text.isNull(), F.lit(None).cast(kind))
        .when(value.isNull(), F.raise_error(problem).cast(kind))
        .otherwise(value)
        .alias(name)
    )


def _inferred(rows: DataFrame, names: list[str]) -> dict[str, T.DataType]:
    """Types of text columns from all their values, in one aggregate."""
    if not names:
        return {}
    aggs = []
    for i, name in enumerate(names):
        text = _known(name)
        aggs += [
            F.count(text).alias(f"n{i}"),
            F.count_if(text.rlike(NUMBER)).alias(f"number{i}"),
            F.count(_whole(text)).alias(f"whole{i}"),
            F.count_if(text.isin("True", "False", "TRUE", "FALSE", "true", "false")).alias(f"flag{i}"),
        ]
    counts = rows.agg(*aggs).first()
    out: dict[str, T.DataType] = {}
    for i, name in enumerate(names):
        known = counts[f"n{i}"]
        if known and counts[f"flag{i}"] == known:
            out[name] = T.BooleanType()
        elif known and counts[f"whole{i}"] == known:
            out[name] = T.LongType()
        elif counts[f"number{i}"] == known:
            out[name] = T.DoubleType()
        else:
            out[name] = T.StringType()
    return out


def _read_csv(spark: SparkSession, path: str, ddl: str | None) -> DataFrame:
    """Every CSV column with its declared type, the others with a type all values fit.

    Columns are matched by name. Nothing is dropped on the way: missing spellings become
    NULL, a whole number may be written 3.0, and any other misfit fails the job.
    """
    rows = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    declared = {f.name: f.dataType for f in T.StructType.fromDDL(ddl).fields} if ddl else {}
    kinds = declared | _inferred(rows, [c for c in rows.columns if c not in declared])
    return rows.select([_typed(c, kinds[c]) for c in rows.columns])


def scan(spark: SparkSession, path: str, fmt: str = "auto", ddl: str | None = None) -> DataFrame:
    """Read one table; ``auto`` takes Parquet for ``.parquet``/``.pq`` paths, else CSV.

    CSV columns that the schema does not name are typed by one pass over all rows, so
    keep a table as Parquet after its first load.
    """
    if fmt not in ("auto", "parquet", "csv"):
        raise ValueError(f"Unknown table format: {fmt}")
    if fmt == "parquet" or (fmt == "auto" and path.rstrip("/").endswith((".parquet", ".pq"))):
        return spark.read.parquet(path)
    return _read_csv(spark, path, ddl)


def clean(df: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    """Stray NaN, the day sentinel and the table's own category sentinels become NULL."""
    out = sentinel_to_null(nan_to_null(df))
    for column, value in spec.extra_sentinels if spec else ():
        out = sentinel_to_null(out, [column], value)
    return out


def load_table(
    spark: SparkSession, name: str, directory: str | None = None, path: str | None = None
) -> DataFrame:
    """Scan and clean one of the eight tables with its declared schema."""
    spec = TABLES[name]
    source = path or f"{str(directory).rstrip('/')}/{spec.file}"
    return clean(scan(spark, source, "auto", spec.ddl), spec)


def load_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {name: load_table(spark, name, directory) for name in TABLES}


def loan_bridge(bureau: DataFrame) -> DataFrame:
    """Loan to applicant keys; a column-pruned scan of the loan table."""
    return bureau.select("SK_ID_CURR", "SK_ID_BUREAU")
