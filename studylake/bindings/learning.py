"""Driver tables read as the seven raw learning tables.

Orders stand for enrollments (priority is the module, year the presentation),
customers for students, parts for assessments and resources, line items for
submissions and clicks. All bronze columns are text with placeholders, mixed case,
malformed values and a second load, derived from the columns of every row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.plans import gold, silver
from studylake.session import materialize

FIRST_LOAD, SECOND_LOAD = "2024-01-01 00:00:00", "2024-01-08 00:00:00"
AS_OF = "2024-01-10"

#: Rows of a stored file: a read task takes some 26 small files, so its rows fit a sort in memory.
_FILE_ROWS = 100_000


def _case(*branches, default=None) -> Column:
    (condition, value), *rest = branches
    result = F.when(condition, value)
    for condition, value in rest:
        result = result.when(condition, value)
    return result if default is None else result.otherwise(default)


def _text(c: Column) -> Column:
    return c.cast("string")


def _loaded(df: DataFrame, moment: Column | str) -> DataFrame:
    stamp = F.lit(moment).cast("timestamp") if isinstance(moment, str) else moment
    return df.withColumn("ingestion_timestamp", stamp).withColumn(
        "ingestion_date", F.to_date(stamp)
    )


def _presentation() -> Column:
    return F.concat(_text(F.year("o_orderdate")), F.lit("J"))


class Lazy(dict):
    """Frames by name, each built when first asked for."""

    def __init__(self, build: Callable[[str], DataFrame]):
        super().__init__()
        self._build = build

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._build(name)
        return self[name]


class Learning:
    """Bronze, silver and gold frames over one folder of driver tables, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._stored: set[tuple[str, str]] = set()

    @cached_property
    def _tables(self) -> dict[str, DataFrame]:
        return Lazy(lambda name: self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def table(self, name: str) -> DataFrame:
        return self._tables[name]

    def store(self, layer: str, name: str, *columns: str) -> DataFrame:
        """A table of ``bronze``, ``silver`` or ``gold``, written now and read by all that follows.

        With ``columns`` only these, so that what the query does not read is not computed.
        """
        frames = getattr(self, layer)
        if (layer, name) not in self._stored:
            frame = frames[name].select(*columns) if columns else frames[name]
            frames[name] = materialize(frame, _FILE_ROWS)
            self._stored.add((layer, name))
        return frames[name]

    # --- bronze -------------------------------------------------------------

    def courses(self) -> DataFrame:
        days = F.datediff(F.max("o_orderdate"), F.min("o_orderdate"))
        base = (
            self.table("orders")
            .groupBy(F.col("o_orderpriority").alias("m"), _presentation().alias("p"))
            .agg(_text(days).alias("module_presentation_length"))
        )
        length = "module_presentation_length"
        first, second = [F.lit(day).cast("timestamp") for day in (FIRST_LOAD, SECOND_LOAD)]
        again = F.concat(F.lit(" "), F.lower("m"), F.lit(" ")), F.lower("p"), second
        loads = [
            F.struct(m.alias("m"), p.alias("p"), day.alias("_load"))
            for m, p, day in ((F.col("m"), F.col("p"), first), again)
        ]
        rows = base.select(F.inline(F.array(*loads)).alias("code_module", "code_presentation", "_load"),
                           length)
        return _loaded(rows.select("code_module", "code_presentation", length, "_load"),
                       F.col("_load")).drop("_load")

    def _parts(self) -> DataFrame:
        size, brand = F.col("p_size"), F.substring("p_brand", 7, 2).cast("int")
        module = _case(
            (size <= 10, "1-URGENT"), (size <= 20, " 2-high"), (size <= 30, "3-Medium "),
            (size <= 40, "4-NOT SPECIFIED"), default="5-LOW",
        )
        return (
            self.table("part")
            .withColumn("brand", brand)
            .withColumn("code_module", module)
            .withColumn(
                "code_presentation",
                F.concat(_text(F.lit(1995) + F.floor((F.col("brand") - 1) / 3)), F.lit("j")),
            )
        )

    def assessments(self) -> DataFrame:
        kind, size = F.col("p_type"), F.col("p_size")
        key = _text(F.col("p_partkey"))
        rows = self._parts().select(
            "code_module", "code_presentation",
            F.when((kind == "LARGE") & (size > 45), F.concat(F.lit("A"), key))
            .otherwise(key).alias("id_assessment"),
            _case(
                (kind == "STANDARD", "tma"), (kind == "ECONOMY", " CMA"), (kind == "PROMO", "exam"),
                (kind == "LARGE", "TMA"), (kind == "SMALL", "Cma"), (size > 40, "QUIZ"),
                (size > 35, F.lit(None).cast("string")), default="EXAM",
            ).alias("assessment_type"),
            _case(
                (kind == "PROMO", "?"),
                ((kind == "MEDIUM") & (size <= 5), F.lit(None).cast("string")),
                (kind == "MEDIUM", "?"),
                ((kind == "SMALL") & (size == 7), "12.5"),
                ((kind == "SMALL") & (size == 8), "soon"),
                default=_text(size * 25 - 20),
            ).alias("date"),
            _case(
                ((kind == "SMALL") & (size == 9), "n/a"),
                ((kind == "LARGE") & (size == 3), F.lit(None).cast("string")),
                (kind == "PROMO", "100"),
                default=_text(F.floor("p_retailprice") - 895),
            ).alias("weight"),
            "brand", "p_type", "p_size",
        )
        own = ["code_module", "code_presentation", "id_assessment", "assessment_type", "date",
               "weight"]
        corrected = F.when((kind == "ECONOMY") & (size < 5), "1").otherwise(F.col("weight"))
        again = rows.filter(F.col("brand") > 12).withColumn("weight", corrected)
        return _loaded(rows.select(*own), FIRST_LOAD).unionByName(
            _loaded(again.select(*own), SECOND_LOAD)
        )

    def vle(self) -> DataFrame:
        kind, size = F.col("p_type"), F.col("p_size")
        unknown = kind.isin("STANDARD", "LARGE")
        rows = self._parts().select(
            _text(F.col("p_partkey")).alias("id_site"), "code_module", "code_presentation",
            F.when((kind == "PROMO") & (size > 48), F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(" "), kind)).alias("activity_type"),
            F.when(unknown, "?").otherwise(_text(size)).alias("week_from"),
            _case(
                (unknown, "?"), ((kind == "ECONOMY") & (size > 45), "x"),
                (kind == "SMALL", _text(size - 1)), default=_text(size + 2),
            ).alias("week_to"),
            "brand",
        )
        again = rows.filter(F.col("brand") > 12).withColumn(
            "activity_type", F.lower("activity_type")
        )
        return _loaded(rows.drop("brand"), FIRST_LOAD).unionByName(
            _loaded(again.drop("brand"), SECOND_LOAD)
        )

    def student_info(self) -> DataFrame:
        balance, region = F.col("c_acctbal"), F.col("n_regionkey")
        segment, status, price = F.col("c_mktsegment"), F.col("o_orderstatus"), F.col("o_totalprice")
        people = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "c_acctbal", "c_mktsegment", "n_name", "n_regionkey")
        )
        decile = F.floor(balance / 1000).cast("int")
        return _loaded(
            self.table("orders").join(people, F.col("o_custkey") == F.col("c_custkey")),
            F.col("o_orderdate"),
        ).select(
            F.when(status == "P", F.lower("o_orderpriority"))
            .otherwise(F.col("o_orderpriority")).alias("code_module"),
            _presentation().alias("code_presentation"),
            _text(F.col("o_custkey")).alias("id_student"),
            _case(
                (segment == "BUILDING", "M"), (segment == "MACHINERY", "f"),
                (segment == "HOUSEHOLD", "F"), (segment == "AUTOMOBILE", "m"),
                (balance < 0, "U"), default="M",
            ).alias("gender"),
            F.concat("n_name", F.lit(" ")).alias("region"),
            segment.alias("highest_education"),
            F.when(balance < 0, "?").otherwise(
                F.concat(_text(decile * 10), F.lit("-"), _text(decile * 10 + 10), F.lit("%"))
            ).alias("imd_band"),
            _case((region <= 1, "0-35"), (region <= 3, "35-55"), default="55<=").alias("age_band"),
            _text(F.floor(price / 150000)).alias("num_of_prev_attempts"),
            _text(F.floor(price / 1500)).alias("studied_credits"),
            _case(
                (region == 2, "Y"), (region == 3, "?"),
                (balance > 9000, F.lit(None).cast("string")), default="n",
            ).alias("disability"),
            _case(
                (status == "F", "Withdrawn"), (status == "P", " Fail "),
                (price > 400000, "Distinction"), default="Pass",
            ).alias("final_result"),
            "ingestion_timestamp", "ingestion_date",
        )

    def student_registration(self) -> DataFrame:
        price, status = F.col("o_totalprice"), F.col("o_orderstatus")
        start = F.dayofyear("o_orderdate") - 200
        return _loaded(self.table("orders"), F.col("o_orderdate")).select(
            F.when(status == "P", F.lower("o_orderpriority"))
            .otherwise(F.col("o_orderpriority")).alias("code_module"),
            _presentation().alias("code_presentation"),
            _text(F.col("o_custkey")).alias("id_student"),
            _case(
                (price < 20000, "?"), (price < 25000, F.lit(None).cast("string")),
                default=_text(start),
            ).alias("date_registration"),
            F.when(
                status == "F", _text(start + F.floor(price / 2500).cast("int") - 10)
            ).alias("date_unregistration"),
            "ingestion_timestamp", "ingestion_date",
        )

    def _lines(self, *own: Column) -> DataFrame:
        """Line items beside their order. With ``own``, columns of the line alone, both are narrow before they meet.

        The orders of a shuffle partition are hashed, so that neither side is sorted.
        """
        orders = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"
        )
        lines = self.table("lineitem")
        if own:
            orders = orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
            shipped = F.to_date("l_shipdate").alias("l_shipdate")
            lines = lines.select("l_orderkey", "l_partkey", shipped, *own)
        return lines.join(
            orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")
        ).withColumn("day", F.datediff("l_shipdate", "o_orderdate"))

    def student_assessment(self) -> DataFrame:
        tax, discount, flag = F.col("l_tax"), F.col("l_discount"), F.col("l_returnflag")
        quantity, student = F.col("l_quantity").cast("int"), _text(F.col("o_custkey"))
        first, second = [F.lit(day).cast("timestamp") for day in (FIRST_LOAD, SECOND_LOAD)]
        lines = self._lines(
            ((F.col("l_linenumber") == 7) & (tax == 0.0)).alias("_marked"),
            _case(
                (tax == 0.08, "2"), ((tax == 0.0) & (flag == "R"), F.lit(None).cast("string")),
                (flag == "A", "1"), default="0",
            ).alias("is_banked"),
            _case(
                (discount == 0.1, "?"), (discount == 0.09, F.lit(None).cast("string")),
                (discount == 0.0, "NaN"), ((discount == 0.08) & (quantity > 48), "abc"),
                (quantity > 49, "101"), default=_text(quantity * 2),
            ).alias("score"),
            (flag == "R").alias("_again"),
        )
        rows = lines.select(
            _text(F.col("l_partkey")).alias("id_assessment"),
            F.when(F.col("_marked"), F.concat(F.lit("S"), student))
            .otherwise(student).alias("id_student"),
            _text(F.col("day")).alias("date_submitted"),
            "is_banked", "score",
            F.explode(F.when(F.col("_again"), F.array(first, second)).otherwise(F.array(first))).alias(
                "_load"),
        )
        return _loaded(rows, F.col("_load")).drop("_load")

    def student_vle(self) -> DataFrame:
        clicks = (F.col("l_quantity").cast("int") - 1).alias("_clicks")
        return _loaded(self._lines(clicks).select(
            F.lower("o_orderpriority").alias("code_module"),
            _presentation().alias("code_presentation"),
            _text(F.col("o_custkey")).alias("id_student"),
            _text(F.col("l_partkey")).alias("id_site"),
            _text(F.col("day")).alias("date"),
            _text(F.col("_clicks")).alias("sum_click"),
        ), FIRST_LOAD)

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return Lazy(lambda name: getattr(self, name)())

    # --- further layers ----------------------------------------------------------

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return Lazy(lambda name: silver.CLEANERS[name](self.bronze[name]))

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        return Lazy(lambda name: gold.BUILDERS[name](self.silver, self.gold, self.spark))
