"""Raw traffic extracts derived from the given benchmark tables.

The warehouse consumes three raw extracts (AADF by direction, count points,
hourly raw counts).  For the shared test data they are derived, with
integer arithmetic on keys only, from ``part``, ``lineitem``, ``nation``
and ``region`` so that every derived table grows with the inputs and a
SQL engine can recompute them exactly.  Dirty rows are planted on purpose
(bad directions, 'bad' numbers, negative counts, out-of-range years, measures
too large for the fact, points at two positions, hour 24, missing years).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..schemas import VEHICLE_COLS

# Fixed values of the stand-in recipe: p_type word -> road category, and
# line number -> direction of travel.
TYPE_TO_CATEGORY = {
    "STANDARD": "TM", "ECONOMY": "PM", "MEDIUM": "TA", "PROMO": "PA", "SMALL": "MB",
}
LINE_TO_DIRECTION = {1: "N", 2: "S", 3: "E", 4: "W", 5: "C", 6: "N", 7: "S"}
MAJOR = ("TM", "PM", "TA", "PA")
CATEGORIES = (*TYPE_TO_CATEGORY.values(), "MCU")
LEFT_OUT_MOD, LEFT_OUT_REM = 211, 210
OVER_RANGE = "12345678901234567890"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map(mapping: dict):
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation + region names (a fixed 25-row reference table)."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(bounded_broadcast(r, 10_000), n.n_regionkey == r.r_regionkey).drop("r_regionkey")


def _numbered_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`nations` with a number in ``_nation`` that stands for the row (a fixed reference table)."""
    nat = nations(spark, sf_dir)
    return bounded_broadcast(nat.withColumn("_nation", F.row_number().over(Window.orderBy(*nat.columns))), 10_000)


def _category_from_type(p_type) -> F.Column:
    word = F.split(p_type, " ").getItem(0)
    return F.coalesce(F.try_element_at(_map(TYPE_TO_CATEGORY), word), F.lit("MCU"))


def _road_name(category, partkey) -> F.Column:
    prefix = (
        F.when(category.isin("TM", "PM"), "M")
        .when(category.isin("TA", "PA"), "A")
        .when(category == "MB", "B")
        .otherwise("U")
    )
    return F.concat(prefix, (partkey % 50).cast("string"))


def road_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road-segment attribute table: every part is a segment."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    cat = _category_from_type(F.col("p_type"))
    return p.select(
        F.col("p_partkey").alias("CP_Number"),
        _road_name(cat, F.col("p_partkey")).alias("RoadNumber"),
    )


def _latitude(partkey: str) -> F.Column:
    return F.expr(f"CAST(50 + ({partkey} % 900) * 0.01 AS DECIMAL(10,8))")


def _longitude(partkey: str) -> F.Column:
    return F.expr(f"CAST(-6 + ({partkey} % 800) * 0.01 AS DECIMAL(11,8))")


def _link_length(category, size) -> F.Column:
    """NULL for a minor road or an unknown one."""
    length = F.when(size % 10 == 0, F.lit(0)).otherwise(size * F.lit("0.1").cast("decimal(1,1)"))
    return F.when(category.isin(*MAJOR), length).cast("decimal(8,3)")


def point_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per count point (parts, minus the left-out ones)."""
    p = (
        read_table(spark, sf_dir, "part")
        .select("p_partkey", "p_type", "p_size")
        .where(F.col("p_partkey") % LEFT_OUT_MOD != LEFT_OUT_REM)
    )
    nat = bounded_broadcast(nations(spark, sf_dir), 10_000)
    p = p.join(nat, (F.col("p_partkey") % 25) == F.col("n_nationkey"))
    cat = _category_from_type(F.col("p_type"))
    return (
        p.withColumn("road_category", cat)
        .withColumn(
            "road_type",
            F.when(F.col("road_category").isin(*MAJOR), "Major").otherwise("Minor"),
        )
        .select(
            F.col("p_partkey").alias("count_point_id"),
            F.col("n_regionkey").cast("int").alias("region_id"),
            F.col("r_name").alias("region_name"),
            F.concat(F.lit("E120000"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0")).alias(
                "region_ons_code"
            ),
            F.col("n_nationkey").cast("int").alias("local_authority_id"),
            F.col("n_name").alias("local_authority_name"),
            F.concat(F.lit("E06"), F.lpad(F.col("n_nationkey").cast("string"), 6, "0")).alias(
                "local_authority_code"
            ),
            _road_name(F.col("road_category"), F.col("p_partkey")).alias("road_name"),
            "road_category",
            "road_type",
            _latitude("p_partkey").alias("latitude"),
            _longitude("p_partkey").alias("longitude"),
            _link_length(F.col("road_category"), F.col("p_size")).alias("link_length_km"),
            "p_size",
        )
    )


def count_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count-point extract; every tenth point appears twice (years 2000, 2001)."""
    base = point_attributes(spark, sf_dir).drop("p_size")
    cols = [c for c in base.columns]
    first = base.withColumn("year", F.lit(2000))
    second = base.where(F.col("count_point_id") % 10 == 0).withColumn("year", F.lit(2001))
    ordered = ["count_point_id", "year"] + [c for c in cols if c != "count_point_id"]
    return first.select(*ordered).unionByName(second.select(*ordered))


def _lineitem_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    return li.withColumn("_q", F.col("l_quantity").cast("bigint"))


def _measures(signed: bool, as_text: bool) -> dict:
    q, k, pk = F.col("_q"), F.col("l_orderkey"), F.col("l_partkey")
    cars = q * 400 + pk % 100
    if signed:
        cars = F.when(k % 113 == 0, -cars).otherwise(cars)
    out = {
        "pedal_cycles": q % 7,
        "two_wheeled_motor_vehicles": q % 11,
        "cars_and_taxis": cars,
        "buses_and_coaches": q % 13,
        "LGVs": q * 20,
        "HGVs_2_rigid_axle": q * 3,
        "HGVs_3_rigid_axle": q,
        "HGVs_4_or_more_rigid_axle": q % 5,
        "HGVs_3_or_4_articulated_axle": q % 3,
        "HGVs_5_articulated_axle": q * 2,
        "HGVs_6_articulated_axle": q * 4,
        "all_HGVs": q * 10 + q % 5 + q % 3,
        "all_motor_vehicles": q * 430 + pk % 100 + q % 11 + q % 13 + q % 5 + q % 3,
    }
    if as_text:
        out = {c: v.cast("string") for c, v in out.items()}
        out["pedal_cycles"] = F.when(k % 109 == 0, F.lit("bad")).otherwise(out["pedal_cycles"])
        big = "two_wheeled_motor_vehicles"
        out[big] = F.when(k % 1009 == 0, F.lit(OVER_RANGE)).otherwise(out[big])
    return out


def _with_points(spark: SparkSession, sf_dir: str, li: DataFrame, cols: list[str]) -> DataFrame:
    pts = point_attributes(spark, sf_dir).select("count_point_id", *cols)
    # Hashed by part, so a task holds its share of the parts and never sorts its share of the line items.
    return li.join(pts.hint("shuffle_hash"), li.l_partkey == pts.count_point_id, "left").drop("count_point_id")


def _traits(nation: F.Column, category: F.Column, counted: F.Column) -> F.Column:
    """A nation's number, a road category (or none) and a flag in one number: a column costs a shuffle more than its
    content."""
    number = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), category), F.lit(0))
    return nation.cast("bigint") * 16 + number * 2 + F.when(counted, 1).otherwise(0)


def _nation_of(traits: F.Column) -> F.Column:
    return F.shiftright(traits, 4)


def _category_of(traits: F.Column) -> F.Column:
    numbered = F.array(F.lit(None).cast("string"), *[F.lit(c) for c in CATEGORIES])
    return F.get(numbered, F.shiftright(traits, 1).bitwiseAND(F.lit(7)).cast("int"))


def _counted(traits: F.Column) -> F.Column:
    return traits.bitwiseAND(F.lit(1)) == 1


def aadf_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the raw AADF rows are computed from, with the (order, line) key that orders them: much narrower than they
    are, so this is what shuffles should move. Of a point it holds the part's category and size, of a nation its number
    (:func:`with_nations` adds the rest after the shuffles); the category, the number and whether the row was counted
    stand in one column (:func:`_traits`)."""
    li = _lineitem_base(spark, sf_dir)
    year = F.when(F.col("l_orderkey") % 101 == 0, F.lit(1990)).otherwise(F.year("l_shipdate") + 22).cast("int")
    li = li.select(
        "l_orderkey", "l_partkey", "l_linenumber", "_q", year.alias("year"), (F.col("l_returnflag") == "R").alias("_counted"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("estimation_method_detailed"))
    li = _with_points(spark, sf_dir, li, ["road_category", "p_size"])
    nat = _numbered_nations(spark, sf_dir).select("n_nationkey", "_nation")
    li = li.join(nat, (F.col("l_partkey") % 25) == F.col("n_nationkey")).drop("n_nationkey")
    return li.withColumn("_traits", _traits(F.col("_nation"), F.col("road_category"), F.col("_counted"))).drop(
        "_nation", "road_category", "_counted")


def with_nations(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """:func:`aadf_rows` with their traits as columns, and the names and keys of their nations and regions, one partner
    for each row."""
    nat = _numbered_nations(spark, sf_dir).drop("n_name")
    traits = F.col("_traits")
    return rows.join(nat, _nation_of(traits) == F.col("_nation")).withColumns(
        {"road_category": _category_of(traits), "_counted": _counted(traits)}).drop("_nation", "_traits")


def aadf_columns() -> list[F.Column]:
    """The columns of a raw AADF row over :func:`aadf_rows` with their nations."""
    k, category = F.col("l_orderkey"), F.col("road_category")
    direction = (
        F.when(k % 103 == 0, F.lit("X"))
        .when(k % 107 == 0, F.lit(None).cast("string"))
        .otherwise(F.try_element_at(_map(LINE_TO_DIRECTION), F.col("l_linenumber")))
    )
    measures = _measures(signed=True, as_text=True)
    # some rows state the point half a degree further north and west
    moved = F.when(k % 139 == 0, F.lit("0.5").cast("decimal(2,1)")).otherwise(F.lit("0.0").cast("decimal(2,1)"))
    known = category.isNotNull()  # a row of a left-out part has no point
    return [
        F.col("l_partkey").alias("count_point_id"),
        F.col("year"),
        F.col("n_regionkey").cast("int").alias("region_id"),
        F.col("r_name").alias("region_name"),
        F.col("n_nationkey").cast("int").alias("local_authority_id"),
        F.when(known, _road_name(category, F.col("l_partkey"))).alias("road_name"),
        category,
        direction.alias("direction_of_travel"),
        F.when(known, (_latitude("l_partkey") + moved)).cast("decimal(10,8)").alias("latitude"),
        F.when(known, (_longitude("l_partkey") - moved)).cast("decimal(11,8)").alias("longitude"),
        _link_length(category, F.col("p_size")).alias("link_length_km"),
        F.when(F.col("_counted"), "Counted").otherwise("Estimated").alias("estimation_method"),
        F.col("estimation_method_detailed"),
        *[measures[c].alias(c) for c in VEHICLE_COLS],
    ]


def raw_aadf(spark: SparkSession, sf_dir: str, by: str | None = None) -> DataFrame:
    """AADF-by-direction extract, one row per lineitem, measures as text.

    ``by`` deals the rows out by a column (``year``) for a partitioned write:
    few large files each, where AQE splits an oversized one, and sorted, so the
    writer need not sort the wide rows; rows of a part stand together, which
    takes less room."""
    rows = aadf_rows(spark, sf_dir)
    if by:
        rows = rows.hint("rebalance", by)
    rows = with_nations(spark, sf_dir, rows)
    if by:
        rows = rows.sortWithinPartitions(by, "l_partkey")
    return rows.select(*aadf_columns())


def as_delivered(df: DataFrame) -> DataFrame:
    """An extract as a source may write it: columns in another order, one more
    column, ids with a decimal point, and a word for missing texts."""
    out = []
    for name, kind in reversed(df.dtypes):
        if name in ("region_id", "local_authority_id"):
            out.append(F.concat(F.col(name).cast("string"), F.lit(".0")).alias(name))
        elif kind == "string":
            out.append(F.coalesce(F.col(name), F.lit("NA")).alias(name))
        else:
            out.append(F.col(name))
    return df.select(F.lit("v1").alias("extract_version"), *out)


def raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly raw counts, one row per lineitem."""
    li = _with_points(spark, sf_dir, _lineitem_base(spark, sf_dir), ["road_category"])
    m = _measures(signed=False, as_text=False)
    from ..schemas import RAW_COUNT_MEASURES

    return li.select(
        F.to_date("l_shipdate").alias("count_date"),
        F.when(F.col("l_orderkey") % 131 != 0, F.year("l_shipdate") + 22).cast("int").alias("year"),
        F.when(F.col("l_orderkey") % 127 == 0, F.lit(24)).otherwise(F.lit(7) + F.col("l_orderkey") % 12)
        .cast("int").alias("hour"),
        "road_category",
        *[m[c].cast("bigint").alias(c) for c in RAW_COUNT_MEASURES],
    )


def full_aadf(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """All-directions dataset: direction rows summed per (point, year),
    with a planted +1 on every 17th point."""
    raw = raw if raw is not None else raw_aadf(spark, sf_dir)
    summed = raw.groupBy("count_point_id", "year").agg(
        F.sum(F.col("all_motor_vehicles").cast("decimal(26,4)")).alias("all_motor_vehicles")
    )
    return summed.withColumn(
        "all_motor_vehicles",
        (F.col("all_motor_vehicles") + F.when(F.col("count_point_id") % 17 == 0, 1).otherwise(0)).cast("decimal(26,4)"),
    )


def subset_aadf(spark: SparkSession, sf_dir: str, full: DataFrame | None = None) -> DataFrame:
    """Sample dataset: every third point of the full set, plus each of those
    points once more at year 1900 (rows absent from the full set)."""
    full = (full if full is not None else full_aadf(spark, sf_dir)).where(F.col("count_point_id") % 3 == 0)
    extra = (
        full.select("count_point_id").distinct()
        .withColumn("year", F.lit(1900))
        .withColumn("all_motor_vehicles", F.lit(None).cast("decimal(26,4)"))
    )
    return full.unionByName(extra)
