"""Manufacturing cost: fact table, metrics by dimension, wide table per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import hash_key
from tessera.operators.aggregates import metrics_by, pivot_sum
from tessera.session import materialise
from tessera.sources.writers import conform, save_table

# The cost categories with their keys and wide columns, and the limit of an overrun.
CATEGORIES = {"Material": 1, "Labor": 2, "Overhead": 3, "QC": 4}
WIDE_COLUMNS = {1: "material_cost", 2: "labor_cost", 3: "overhead_cost", 4: "qc_cost"}
OVERRUN_PERCENT = 15

_GRAIN = ["date_id", "product_id", "batch_id", "facility_id", "cost_category_id"]


def _fields(optional: str = "", **types: T.DataType) -> T.StructType:
    """A contract: every column is required unless it is listed as optional."""
    return T.StructType([T.StructField(n, t, n in optional.split()) for n, t in types.items()])


MONEY, RATIO, HOURS = T.DecimalType(12, 2), T.DecimalType(8, 2), T.DecimalType(10, 2)

WHOLE, KEY, TEXT, FLAG, DAY = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType(), T.DateType()
DIMENSIONS = {
    "dim_date": _fields(date_id=WHOLE, full_date=DAY, year=WHOLE, quarter=WHOLE, month=WHOLE, month_name=TEXT, day_of_week=WHOLE),
    "dim_facility": _fields(facility_id=KEY, facility_name=TEXT, city=TEXT, state=TEXT, overhead_rate=HOURS, is_sterile=FLAG),
    "dim_product": _fields(product_id=KEY, product_name=TEXT, dosage_form=TEXT, product_line=TEXT, formulation_version=TEXT, target_batch_size=WHOLE),
    "dim_batch": _fields(
        "rework_hours", batch_id=KEY, facility_id=KEY, batch_status=TEXT, planned_quantity=WHOLE, actual_quantity=WHOLE, qa_hold_days=WHOLE, rework_hours=HOURS
    ),
    "dim_cost_category": _fields(cost_category_id=WHOLE, cost_category_name=TEXT, cost_type=TEXT),
}
FACT = _fields(
    "variance_percent units_produced labor_hours line_hours", material_cost_id=T.StringType(), date_id=T.IntegerType(), product_id=T.LongType(), batch_id=T.LongType(), facility_id=T.LongType(),
    cost_category_id=T.IntegerType(), actual_cost=MONEY, standard_cost=MONEY, cost_variance=MONEY, variance_percent=RATIO,
    units_produced=T.IntegerType(), labor_hours=HOURS, line_hours=HOURS,
)
WIDE = _fields(
    "qa_hold_days rework_hours material_cost labor_cost overhead_cost qc_cost total_actual_cost total_standard_cost total_variance"
    " variance_percent cost_per_unit exceeds_15_percent",
    batch_id=T.LongType(), batch_status=T.StringType(), actual_quantity=T.IntegerType(), year=T.IntegerType(), month=T.IntegerType(),
    facility_name=T.StringType(), is_sterile=T.BooleanType(), overhead_rate=HOURS, product_name=T.StringType(),
    dosage_form=T.StringType(), product_line=T.StringType(), qa_hold_days=T.IntegerType(), rework_hours=HOURS,
    material_cost=MONEY, labor_cost=MONEY, overhead_cost=MONEY, qc_cost=MONEY, total_actual_cost=MONEY, total_standard_cost=MONEY,
    total_variance=MONEY, variance_percent=RATIO, cost_per_unit=HOURS, exceeds_15_percent=T.BooleanType(),
)


def required(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``df`` in the columns and types of a contract; a row without a required value ends the job."""
    columns = []
    for f in contract.fields:
        value = F.col(f.name).cast(f.dataType)
        refused = F.raise_error(F.lit(f"{f.name} is required")).cast(f.dataType)
        columns.append((value if f.nullable else F.coalesce(value, refused)).alias(f.name))
    return conform(df.select(*columns), T.StructType([T.StructField(f.name, f.dataType) for f in contract.fields]))


def write_dimension(df: DataFrame, name: str, database: str) -> DataFrame:
    """One of the declared dimensions as a managed table."""
    return save_table(required(df, DIMENSIONS[name]), f"{database}.{name}")


def date_dimension(days: DataFrame, day: str) -> DataFrame:
    """One row per day that occurs."""
    own = days.select(F.col(day).cast("date").alias("full_date")).distinct()
    return own.select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_id"), "full_date", F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"), F.month("full_date").alias("month"), F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofweek("full_date").alias("day_of_week"),
    )


def category_dimension(lines: DataFrame) -> DataFrame:
    """The cost categories that occur, with their keys; material and labour are direct costs."""
    category = F
    for name, key in CATEGORIES.items():
        category = category.when(F.col("cost_category") == name, F.lit(key))
    kind = F.when(F.col("cost_category").isin("Material", "Labor"), "Direct").otherwise("Indirect")
    return lines.select(category.alias("cost_category_id"), F.col("cost_category").alias("cost_category_name"), kind.alias("cost_type")).distinct()


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage to two digits; NULL when the whole is 0."""
    return F.round(F.try_divide(part.cast("decimal(20,2)") * 100, whole.cast("decimal(20,2)")), 2).cast(RATIO)


def per_unit(cost: Column, units: Column) -> Column:
    return F.round(F.try_divide(cost.cast("decimal(20,2)"), units.cast("decimal(20,0)")), 2)


def cost_lines(lines: DataFrame) -> DataFrame:
    """Lines in cents, summed to one row per date, product, batch, facility and category."""
    category = F
    for name, key in CATEGORIES.items():
        category = category.when(F.col("cost_category") == name, F.lit(key))
    keyed = lines.withColumns({"date_id": F.date_format("full_date", "yyyyMMdd").cast("int"), "cost_category_id": category})
    money = [(F.sum(f"{c}_cents").cast("decimal(18,0)") / 100).cast(MONEY).alias(f"{c}_cost") for c in ("actual", "standard")]
    return keyed.groupBy(*_GRAIN).agg(*money, F.sum("units_produced").cast("int").alias("units_produced"))


def cost_fact(lines: DataFrame) -> DataFrame:
    """The fact table with its variance, keyed by a hash of its grain. Hours are not known from cost lines; a
    standard cost of 0 has no variance in percent."""
    variance = F.col("actual_cost") - F.col("standard_cost")
    fact = cost_lines(lines).withColumns(
        {
            "cost_variance": variance.cast(MONEY),
            "variance_percent": percent_of(variance, F.col("standard_cost")),
            "labor_hours": F.lit(None).cast(HOURS),
            "line_hours": F.lit(None).cast(HOURS),
            "material_cost_id": hash_key(*[F.col(c) for c in _GRAIN]),
        }
    )
    return required(fact, FACT)


def cost_metrics_by_dim(lines: DataFrame) -> DataFrame:
    """Actual, standard, variance, variance percent and cost per unit by batch, product, facility,
    cost category and date.

    Ratios are formed from the sums. A batch reports its units with every category, so for the other
    dimensions they count once, the largest report; there is no cost per unit by category.
    """
    fact = materialise(cost_lines(lines), "cost-lines")
    sums = {
        "actual_cost": F.sum("actual_cost").cast("decimal(18,2)"),
        "standard_cost": F.sum("standard_cost").cast("decimal(18,2)"),
        "units": F.sum("units_produced"),
    }
    run = _GRAIN[:4]
    once = fact.groupBy(*run).agg(
        F.sum("actual_cost").alias("actual_cost"), F.sum("standard_cost").alias("standard_cost"), F.max("units_produced").alias("units_produced")
    )
    by_run = metrics_by(once, ["batch_id", "product_id", "facility_id", "date_id"], sums)
    by_category = metrics_by(fact.withColumn("units_produced", F.lit(None).cast("int")), ["cost_category_id"], sums)
    table = by_run.unionByName(by_category)
    variance = F.col("actual_cost") - F.col("standard_cost")
    return table.select(
        "dimension",
        "member",
        "actual_cost",
        "standard_cost",
        variance.cast("decimal(18,2)").alias("cost_variance"),
        percent_of(variance, F.col("standard_cost")).alias("variance_percent"),
        per_unit(F.col("actual_cost"), F.col("units")).cast("decimal(18,2)").alias("cost_per_unit"),
    )


def cost_ml_wide(lines: DataFrame, batches: DataFrame, facilities: DataFrame, products: DataFrame) -> DataFrame:
    """One wide row per batch, product, facility and month, with a cost column per category."""
    fact = cost_lines(lines).withColumns(
        {"year": F.floor(F.col("date_id") / 10000).cast("int"), "month": F.floor(F.col("date_id") / 100).cast("int") % 100}
    )
    keys = ["batch_id", "product_id", "facility_id", "year", "month"]
    wide = pivot_sum(
        fact,
        keys,
        "cost_category_id",
        WIDE_COLUMNS,
        "actual_cost",
        total_actual_cost=F.sum("actual_cost"),
        total_standard_cost=F.sum("standard_cost"),
    )
    joined = wide.join(batches, "batch_id").join(facilities, "facility_id").join(products, "product_id")
    variance = F.col("total_actual_cost") - F.col("total_standard_cost")
    full = joined.withColumns(
        {
            "total_variance": variance,
            "variance_percent": percent_of(variance, F.col("total_standard_cost")),
            "cost_per_unit": per_unit(F.col("total_actual_cost"), F.col("actual_quantity")),
        }
    ).withColumn("exceeds_15_percent", F.col("variance_percent") > OVERRUN_PERCENT)
    return required(full, WIDE)

