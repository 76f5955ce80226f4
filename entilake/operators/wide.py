"""Entity-attribute-value rows into a typed wide table (problem 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns a wide table may get. More attributes than that cannot be columns of one table, and are refused.
MAX_ATTRIBUTES = 5_000

#: The datatypes a property can have (fixed values of the data model) and the kind of snak value each one takes.
VALUE_KIND = {
    "wikibase-item": "wikibase-entityid",
    "string": "string",
    "commonsmedia": "string",
    "url": "string",
    "time": "time",
    "quantity": "quantity",
    "globe-coordinate": "globecoordinate",
}


def attribute_list(properties: DataFrame) -> list[tuple[int, str]]:
    """(id, datatype) of the properties (columns id, datatype; one row each) that have a known datatype, read without
    letter case and outer blanks, in id order: the columns of the wide table. Bounded by MAX_ATTRIBUTES."""
    name = F.lower(F.trim(F.col("datatype")))
    rows = properties.select("id", name.alias("datatype")).where(F.col("datatype").isin(*VALUE_KIND)).limit(MAX_ATTRIBUTES + 1).collect()
    if len(rows) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes cannot become columns of one table")
    return sorted((r["id"], r["datatype"]) for r in rows)


def real_date(year: Column, month: Column, day: Column) -> Column:
    """Whether the numbers are a date of the (proleptic Gregorian) calendar; years before 1 count from 0 backwards."""
    y = F.abs(year)
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    length = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    return month.between(1, 12) & (day >= 1) & (day <= length)


def fits(datatype: Column) -> Column:
    """Whether a decoded main snak (columns of NODE_FIELDS) is a value of the datatype. Never NULL. No value and some
    value always fit."""
    c = F.col
    text = c("value")
    number = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
    within = lambda name, most: c(name).rlike(number) & F.abs(c(name).try_cast("double")).between(0, most)
    stamp = r"^([+-])(\d+)-(\d{1,2})-(\d{1,2})(T.*)?$"
    part = lambda k: F.regexp_extract("time", stamp, k).try_cast("bigint")
    precision = F.trim(c("time_precision")).try_cast("int")
    a_time = (
        F.when(precision <= 9, c("time").rlike(r"^[+-]\d+(-|$)"))
        .when(precision == 10, c("time").rlike(stamp) & part(3).between(1, 12))
        .when(precision >= 11, c("time").rlike(stamp) & real_date(part(2), part(3), part(4)))
    )
    right = (
        F.when(datatype == "string", c("is_text"))
        .when(datatype == "commonsmedia", c("is_text") & (F.trim(F.regexp_replace(text, r"\s", " ")) != ""))
        .when(datatype == "url", c("is_text") & text.rlike(r"^(?i:https?)://[^\s/?#:@]+[^\s]*$"))
        .when(datatype == "wikibase-item", (F.lower("entity_kind") == "item") & c("entity_id").rlike(r"^\s*\d+\s*$"))
        .when(datatype == "quantity", c("amount").rlike(r"^\s*[+-]?\d+(\.\d+)?\s*$"))
        .when(datatype == "globe-coordinate", within("latitude", 90) & within("longitude", 180))
        .when(datatype == "time", a_time)
    )
    kind = F.create_map(*[F.lit(x) for pair in VALUE_KIND.items() for x in pair])
    is_kind = c("vtype") == kind[datatype]
    return F.coalesce(c("kind").isin("novalue", "somevalue"), F.lit(False)) | F.coalesce(is_kind & right, F.lit(False))


def holds(datatype: Column) -> Column:
    """Whether the column of the datatype holds a fitting value exactly. Never NULL. No value and some value have nothing
    to hold; an id beyond BIGINT and an amount beyond 29 digits before or 9 after the point are too large."""
    c = F.col
    amount = c("amount").rlike(r"^\s*[+-]?0*\d{1,29}(\.\d{0,9}0*)?\s*$")
    large = F.when(datatype == "wikibase-item", F.trim(c("entity_id")).try_cast("bigint").isNotNull()).when(datatype == "quantity", amount).otherwise(True)
    return F.coalesce((c("kind") == "value") & fits(datatype) & large, F.lit(False))


def typed(cell: Column, datatype: str) -> Column:
    """The value of a cell as the type of its column, by try casts: NULL rather than an error, and NULL for an empty cell."""
    if datatype == "wikibase-item":
        return F.trim(cell["entity_id"]).try_cast("bigint")
    if datatype == "quantity":
        return F.trim(cell["amount"]).try_cast("decimal(38,9)")
    if datatype == "globe-coordinate":
        return F.when(cell.isNotNull(), F.struct(F.trim(cell["latitude"]).try_cast("double").alias("latitude"), F.trim(cell["longitude"]).try_cast("double").alias("longitude")))
    if datatype == "time":
        return F.when(cell.isNotNull(), F.struct(cell["time"].alias("time"), F.trim(cell["time_precision"]).try_cast("int").alias("precision")))
    return cell["value"]


def attribute_grid(values: DataFrame, entity: str, attribute: str, order: str, attributes: list[tuple[int, str]], payload: list[str]) -> DataFrame:
    """One row per entity: `entity`, grid ARRAY<STRUCT<n_fit, n_misfit, first>> with a cell for every attribute, in the
    order of `attributes`; cells without a value have counts 0 and first NULL. `first` is the payload of the value with the
    least `order` among those the column holds (see `holds`), so a cell never grows with the number of values.

    values: entity, attribute, order, the columns `fits` reads. Values of other attributes are left out, but an entity in
    `values` without any listed attribute, or with a NULL one only, gets a row of empty cells; repeated rows count as
    often as they are there.

    The cells combine before the shuffle by (entity, position), so an entity or a property with a third of all rows is no
    hot task. An entity then has at most one cell per attribute; they are collected in the order of the positions, and the
    grid is completed inside the row: before each cell as many empty ones as positions were left out, in one pass over the
    cells. That equals the left join of values to an entity-by-attribute grid without shuffling its empty rows."""
    if not attributes:
        attributes = [(None, "string")]
    spark = values.sparkSession
    listed = F.broadcast(spark.createDataFrame([(a, k, d) for k, (a, d) in enumerate(attributes)], "_attribute long, _pos int, _datatype string"))
    at = values.join(listed, F.col(attribute) == F.col("_attribute"), "left")
    at = at.withColumn("_fits", fits(F.col("_datatype"))).withColumn("_holds", holds(F.col("_datatype")))
    ranked = F.struct(F.col(order).alias("_order"), *payload)
    cells = at.groupBy(entity, "_pos").agg(
        F.count_if("_fits").alias("n_fit"),
        F.count_if(~F.col("_fits")).alias("n_misfit"),
        F.min(F.when(F.col("_holds"), ranked)).alias("first"),
    )
    found = F.array_sort(F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.struct("n_fit", "n_misfit", "first").alias("cell"))))).alias("_found")
    empty = F.struct(F.lit(0).cast("bigint").alias("n_fit"), F.lit(0).cast("bigint").alias("n_misfit"), F.lit(None).cast(cells.schema["first"].dataType).alias("first"))
    rows = cells.groupBy(entity).agg(found)
    place = lambda k: F.coalesce(F.get("_found", k)["_pos"], F.lit(-1))
    filled = F.transform("_found", lambda x, k: F.concat(F.array_repeat(empty, x["_pos"] - place(k - 1) - 1), F.array(x["cell"])))
    rest = F.array_repeat(empty, F.lit(len(attributes) - 1) - place(F.size("_found") - 1))
    return rows.select(entity, F.concat(F.flatten(filled), rest).alias("grid"))


def wide_table(grid: DataFrame, entity: str, attributes: list[tuple[int, str]]) -> DataFrame:
    """A typed column p<id> per attribute and n_misfits, projected from fixed places of the grid."""
    columns = [typed(F.col("grid")[k]["first"], d).alias(f"p{a}") for k, (a, d) in enumerate(attributes)]
    misfits = F.aggregate("grid", F.lit(0).cast("bigint"), lambda n, c: n + c["n_misfit"]).alias("n_misfits")
    return grid.select(entity, *columns, misfits)


#: Columns of a cell read back from a wide table, by datatype.
LONG = {"wikibase-item": "item_id", "quantity": "amount", "string": "text_value", "commonsmedia": "text_value", "url": "text_value"}


def long_table(wide: DataFrame, entity: str, attributes: list[tuple[int, str]]) -> DataFrame:
    """The cells of a wide table that hold a value, one row each: entity, property_id, item_id, amount, text_value, latitude,
    longitude, time_value, time_precision; the way back from the wide form."""
    types = {"item_id": "bigint", "amount": "decimal(38,9)", "text_value": "string", "latitude": "double", "longitude": "double", "time_value": "string", "time_precision": "int"}

    def cell(a: int, d: str) -> Column:
        c = F.col(f"p{a}")
        given = {LONG[d]: c} if d in LONG else {"latitude": c["latitude"], "longitude": c["longitude"]} if d == "globe-coordinate" else {"time_value": c["time"], "time_precision": c["precision"]}
        full = next(iter(given.values())).isNotNull()
        return F.when(full, F.struct(F.lit(a).cast("int").alias("property_id"), *[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()]))

    if not attributes:
        return wide.where("false").select(entity, F.lit(0).alias("property_id"), *[F.lit(None).cast(t).alias(n) for n, t in types.items()])
    return wide.select(entity, F.explode(F.array(*[cell(a, d) for a, d in attributes])).alias("_c")).where("_c is not null").select(entity, "_c.*")


def set_apart(values: DataFrame, entity: str, attribute: str, order: str, attributes: list[tuple[int, str]]) -> DataFrame:
    """The values that are in no cell of the wide table, with datatype and reason: `no column` (an attribute without one,
    datatype NULL), `misfit`, `no value` (no value and some value), `too large` (see `holds`), `later` (not the first of
    its cell). Together with the cells these are all rows of `values`, if `order` is unique within an entity. Columns of
    `values` named datatype or reason are replaced. `values` is read three times and should be cut; the first of each cell
    is found by an aggregate that combines before the shuffle."""
    values = values.drop("datatype", "reason")
    spark = values.sparkSession
    listed = F.broadcast(spark.createDataFrame(attributes or [(None, "string")], "_attribute long, datatype string"))
    typed_ = values.join(listed, F.col(attribute) == F.col("_attribute"), "left").drop("_attribute")
    kept = F.coalesce(holds(F.col("datatype")), F.lit(False))
    reason = F.when(F.col("datatype").isNull(), "no column").when(~fits(F.col("datatype")), "misfit").when(F.col("kind") != "value", "no value").when(~kept, "too large")
    judged = typed_.withColumn("_reason", reason)
    first = judged.where("_reason is null").groupBy(entity, attribute).agg(F.min(order).alias("_first"))
    good = judged.where("_reason is null").join(first, [entity, attribute]).where(F.col(order) > F.col("_first")).drop("_first").withColumn("_reason", F.lit("later"))
    return judged.where("_reason is not null").unionByName(good).withColumnRenamed("_reason", "reason")


def misfits(grid: DataFrame, entity: str, attributes: list[tuple[int, str]]) -> DataFrame:
    """(entity, property_id, n_misfit) of the cells that hold values which do not fit their column."""
    ids = F.array(*[F.lit(a).cast("int") for a, _ in attributes]) if attributes else F.array().cast("array<int>")
    cells = grid.select(entity, F.posexplode("grid").alias("_pos", "_cell")).where(F.col("_cell.n_misfit") > 0)
    return cells.select(entity, F.get(ids, F.col("_pos")).alias("property_id"), F.col("_cell.n_misfit").alias("n_misfit"))
