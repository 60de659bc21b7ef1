"""Problem 5: messages whose fields change from file to file, read into one table with a rescue column.

Each line is parsed once into a variant. ``ingest`` enforces a target schema: values under a known or approved
name that fit the column's type fill it, everything else (unknown names, values that do not cast) is kept
as JSON in ``_rescued``. ``replay`` fills columns from rescued values once their names are approved; ``renames`` finds these
names by what the fields measure. ``changes``
compares each file with the one before it and names what was added, removed, renamed or retyped; a
rename is recognised by the measure both fields repeat from the venue's own payload.

Defined results: lines that do not parse are ingested with every column null and the line under
``_rescued._line`` and take no part in the comparison; null values are no values; of two types in one file the
more frequent counts, of equal ones the first by name; the first file of an exchange has no changes; repeated lines
change nothing in the report and stay as they are in the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tideframe.functions import normal
from tideframe.functions.normal import once
from tideframe.session import materialise

#: Field that carries the venue's own payload.
PAYLOAD = "info_json"
_TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def parse(raw: DataFrame, text: str = "raw") -> DataFrame:
    """Adds ``_v``, the line as a variant (null where it does not parse as an object)."""
    p = raw.select("*", once(F.try_parse_json(F.col(text))).alias("_v"))
    return p.withColumn("_v", F.when(F.schema_of_variant("_v").startswith("OBJECT"), F.col("_v")))


def _json_type(s: Column) -> Column:
    """number, string, boolean, object or array, from a variant's schema; null for a JSON null."""
    return (
        F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s != "VOID", "number")
    )


def comparable(text: Column) -> Column:
    """The form in which two values of one measure are equal: numbers and times as a double, else the text."""
    number = F.coalesce(text.try_cast("double"), F.when(text.rlike(r"^\d{4}-\d\d-\d\d[T ]"), F.unix_millis(text.try_cast("timestamp")).cast("double")))
    return F.coalesce(number.cast("string"), text)


def fields(raw: DataFrame, keys: list[str], text: str = "raw") -> DataFrame:
    """One row for each value of a parsed line: keys, name, type and agree, the payload keys that have the same value in the line."""
    p = parse(raw.select(*keys, text), text).filter("_v is not null").select(*keys, "_v")
    info = F.try_variant_get("_v", F.lit(f"$.{PAYLOAD}"), "string")
    p = p.select("*", once(F.transform_values(F.from_json(info, _TEXT_MAP), lambda k, v: comparable(v))).alias("payload"))
    out = p.select(*keys, "payload", F.explode(F.from_json(F.to_json("_v"), T.MapType(T.StringType(), T.VariantType()))).alias("name", "_f"))
    own = F.when(F.col("name") != PAYLOAD, comparable(F.try_variant_get("_f", F.lit("$"), "string")))
    out = out.select(*keys, "payload", "name", F.schema_of_variant("_f").alias("_s"), once(own).alias("_a"))
    agree = F.when(F.col("_a").isNotNull() & F.array_contains(F.map_values("payload"), F.col("_a")), F.map_keys(F.map_filter("payload", lambda k, v: v == F.col("_a"))))
    return out.select(*keys, "name", _json_type(F.col("_s")).alias("type"), agree.alias("agree")).filter("type is not null")


def counted(raw: DataFrame, keys: list[str], text: str = "raw") -> DataFrame:
    """How often each file has each field with each type and each set of agreeing payload keys: all else is found from these few rows.

    The only step that reads the lines; they are parsed once and counted before the shuffle.
    """
    return materialise(fields(raw, keys, text).groupBy(*keys, "name", "type", "agree").agg(F.count("*").alias("n")), "fields")


def measures(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, name, key, hits (lines of the file) and all_hits (of all files that share all keys but the last)."""
    hits = counts.filter("agree is not null").select(*keys, "name", F.explode("agree").alias("key"), "n").groupBy(*keys, "name", "key").agg(F.sum("n").alias("hits"))
    wide = [*keys[:-1], "name", "key"]
    return hits.join(hits.groupBy(*wide).agg(F.sum("hits").alias("all_hits")), wide)


def profile(raw: DataFrame, keys: list[str], text: str = "raw") -> DataFrame:
    """For each file and field its type and its measure, the payload key that most often has its value in the same line.

    Of keys that agree equally often in the file the one that agrees more often in all files counts (``keys`` without the last),
    then the first by spelling; ``undecided`` lists those.
    """
    counts = counted(raw, keys, text)
    by = [*keys, "name"]
    types = counts.groupBy(*by, "type").agg(F.sum("n").alias("n"))
    types = types.groupBy(*by).agg(F.max_by("type", F.struct("n", F.col("type"))).alias("type"), F.sum("n").alias("n"))
    m = measures(counts, keys).groupBy(*by).agg(F.min(F.struct((-F.col("hits")).alias("h"), (-F.col("all_hits")).alias("a"), F.col("key"))).alias("m"))
    return types.join(m.select(*by, F.col("m.key").alias("measure"), (-F.col("m.h")).alias("hits")), by, "left")


def undecided(raw: DataFrame, exchange: str = "exchange", seq: str = "file_seq", text: str = "raw") -> DataFrame:
    """exchange, file_seq, name and the payload keys that agree with the field equally often, in the file and in all files."""
    r = raw.select(normal.exchange(exchange).alias("exchange"), F.col(seq).alias("file_seq"), F.col(text).alias("raw"))
    keys = ["exchange", "file_seq"]
    m = measures(counted(r, keys), keys).groupBy(*keys, "name", "hits", "all_hits").agg(F.sort_array(F.collect_list("key")).alias("same"))
    return m.groupBy(*keys, "name").agg(F.max(F.struct("hits", "all_hits", "same")).alias("m")).select(*keys, "name", F.col("m.same").alias("keys")).filter(F.size("keys") > 1)


def renames(raw: DataFrame, target: dict[str, str], approved: dict[str, str], keys: list[str], text: str = "raw") -> dict[str, str]:
    """Other names of target columns: the fields that over all files measure, in most of their values, what one target column does.

    A target column's measure is that of its own name and its approved names together. A measure that two target columns share
    names neither. Only the names found, a few for each column, come to the driver.
    """
    column = F.create_map(*[F.lit(x) for n, c in ({c: c for c in target} | approved).items() for x in (n, c)])
    prof = profile(raw, keys, text).select("name", F.coalesce(column[F.col("name")], F.lit("")).alias("column"), "measure", "hits", "n")
    prof = materialise(prof.groupBy("name", "column", "measure").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")), "measures")

    def best(d: DataFrame, by: str) -> DataFrame:
        m = d.groupBy(by, "measure").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).groupBy(by)
        m = m.agg(F.min_by(F.struct("measure", "hits"), F.struct(-F.coalesce("hits", F.lit(0)), F.col("measure"))).alias("m"), F.sum("n").alias("n"))
        return m.filter("2 * m.hits > n").select(by, F.col("m.measure").alias("measure"))

    columns = best(prof.filter("column <> ''"), "column").groupBy("measure").agg(F.min("column").alias("column"), F.count("*").alias("of")).filter("of = 1")
    return {r["name"]: r["column"] for r in best(prof.filter("column = ''"), "name").join(columns, "measure").collect()}


def before(files: DataFrame, by: str, seq: str, width: int = 100_000) -> DataFrame:
    """Adds ``prev``, the greatest number below each file's own among the files of its key (null for the first).

    Found within stretches of numbers and carried across them, so no task sorts all files of a key.
    """
    d = files.filter(F.col(seq).isNotNull()).withColumn("_st", F.floor(F.col(seq) / width))
    ends = d.groupBy(by, "_st").agg(F.max(seq).alias("_m"))
    ends = ends.select(by, "_st", F.lag("_m").over(W.partitionBy(by).orderBy("_st")).alias("_carry"))
    inner = F.lag(seq).over(W.partitionBy(by, "_st").orderBy(seq))
    return d.withColumn("_in", inner).join(ends, [by, "_st"]).select(by, seq, F.coalesce("_in", "_carry").alias("prev"))


def changes(raw: DataFrame, exchange: str = "exchange", seq: str = "file_seq", text: str = "raw") -> DataFrame:
    """exchange, file_seq, change, old_field, new_field for each file against the one before it.

    Only the profile, a few rows a file, is compared, each file's with that of the file before it. A
    file none of whose lines parse still counts as a file, without fields.
    """
    r = raw.select(normal.exchange(exchange).alias("exchange"), F.col(seq).alias("file_seq"), F.col(text).alias("raw"))
    prof = profile(r, ["exchange", "file_seq"])
    known = materialise(prof.groupBy("exchange", "file_seq").agg(F.collect_list(F.struct("name", "type", "measure")).alias("fs")), "known")
    seqs = before(r.select("exchange", "file_seq").distinct(), "exchange", "file_seq").filter("prev is not null")
    none = F.array().cast("array<struct<name:string,type:string,measure:string>>")
    both = seqs.join(known, ["exchange", "file_seq"], "left").join(known.select("exchange", F.col("file_seq").alias("prev"), F.col("fs").alias("before")), ["exchange", "prev"], "left")
    both = both.withColumns({"fs": F.coalesce("fs", none), "before": F.coalesce("before", none)})
    names = lambda a: F.transform(a, lambda x: x["name"])
    both = both.select(
        "exchange", "file_seq", "fs", "before",
        F.filter("before", lambda x: ~F.array_contains(names(F.col("fs")), x["name"])).alias("gone"),
        F.filter("fs", lambda x: ~F.array_contains(names(F.col("before")), x["name"])).alias("come"),
    )
    both = materialise(both, "profiles")  # a row a file, asked several times below
    keys = ["exchange", "file_seq"]
    gone = both.select(*keys, F.explode("gone").alias("g")).select(*keys, F.col("g.name").alias("old_field"), F.col("g.type").alias("old_type"), F.col("g.measure").alias("measure"))
    come = both.select(*keys, F.explode("come").alias("c")).select(*keys, F.col("c.name").alias("new_field"), F.col("c.type").alias("new_type"), F.col("c.measure").alias("measure"))
    # A measure is renamed at most once between two files: the first name on either side by spelling.
    one = lambda df, n: df.filter("measure is not null").groupBy(*keys, "measure").agg(F.min(F.struct(n[0], n[1])).alias("v")).select(*keys, "measure", "v.*")
    renamed = one(gone, ("old_field", "old_type")).join(one(come, ("new_field", "new_type")), [*keys, "measure"])
    kept = both.select(*keys, F.explode("fs").alias("c"), "before").select(*keys, "c", F.expr("get(filter(before, x -> x.name = c.name), 0)").alias("b")).filter("b.type <> c.type")
    lit = F.lit
    return (
        renamed.select(*keys, lit("renamed").alias("change"), "old_field", "new_field")
        .unionByName(renamed.filter("old_type <> new_type").select(*keys, lit("retyped").alias("change"), "old_field", "new_field"))
        .unionByName(kept.select(*keys, lit("retyped").alias("change"), F.col("c.name").alias("old_field"), F.col("c.name").alias("new_field")))
        .unionByName(gone.join(renamed, [*keys, "old_field"], "left_anti").select(*keys, lit("removed").alias("change"), "old_field", lit("").alias("new_field")))
        .unionByName(come.join(renamed, [*keys, "new_field"], "left_anti").select(*keys, lit("added").alias("change"), lit("").alias("old_field"), "new_field"))
    )


def _cast(text: Column, kind: str) -> Column:
    if kind == "string":
        return text
    if kind == "epoch_ms":
        return F.coalesce(text.try_cast("long"), F.unix_millis(text.try_cast("timestamp")))
    return text.try_cast(kind)


def ingest(raw: DataFrame, target: dict[str, str], approved: dict[str, str], keep: list[str], text: str = "raw") -> DataFrame:
    """One typed row for each line, with unknown and uncastable fields as JSON in ``_rescued``.

    target: column to type (double, long, string, epoch_ms); approved: other names to target columns. Where
    a line has a column under several names the target's own name goes first, then the approved by spelling.
    """
    m = F.from_json(F.to_json("_v"), _TEXT_MAP)
    df = parse(raw.select(*keep, text), text).select(*keep, F.col(text).alias("_line"), F.col("_v").isNull().alias("_bad"), once(m).alias("_m"))
    names = {c: [c, *sorted(a for a, t in approved.items() if t == c)] for c in target}
    get = lambda c, k: F.coalesce(*[_cast(F.try_element_at("_m", F.lit(n)), k) for n in names[c]])
    df = df.select("*", *[get(c, k).alias(f"_c_{c}") for c, k in target.items()])

    def extra(k: Column, v: Column) -> Column:
        ok = F.lit(False)
        for c, kind in target.items():
            ok = ok | (k.isin(names[c]) & _cast(v, kind).isNotNull())
        return v.isNotNull() & ~ok

    left = F.map_filter("_m", extra)
    rescued = F.when(F.col("_bad"), F.to_json(F.struct("_line"))).when(F.size(left) > 0, F.to_json(left))
    return df.select(*keep, *[F.col(f"_c_{c}").alias(c) for c in target], rescued.alias("_rescued"))


def replay(table: DataFrame, target: dict[str, str], approved: dict[str, str]) -> DataFrame:
    """Fill null columns from rescued values under newly approved names, and take those values out of the rescue column."""
    m = F.from_json("_rescued", _TEXT_MAP)
    df = table.withColumn("_m", m)
    out = {}
    used: dict[str, str] = {}
    for c, kind in target.items():
        mine = sorted(a for a, t in approved.items() if t == c)
        if mine:
            out[c] = F.coalesce(F.col(c), *[_cast(F.try_element_at("_m", F.lit(n)), kind) for n in mine])
            used |= dict.fromkeys(mine, kind)

    def stays(k: Column, v: Column) -> Column:
        gone = F.lit(False)
        for n, kind in used.items():
            gone = gone | ((k == n) & _cast(v, kind).isNotNull())
        return ~gone

    left = F.map_filter("_m", stays)
    out["_rescued"] = F.when(F.size(left) > 0, F.to_json(left))
    return df.withColumns(out).drop("_m")
