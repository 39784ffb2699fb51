"""Lookup tables and the joins that use them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aduana.functions.codes import code_prefix, code_text, starts_with, text_literal
from aduana.functions.frames import quoted, unused_name
from aduana.operators.filters import LEVEL_COLUMNS

# Direction of trade by id.
DIRECTION_NAMES = {1: "Imports", 2: "Exports"}

# HS headings that count as agricultural, as numbers (a heading below 1000 has a leading zero).
AGRICULTURAL_HEADINGS = (
    106, 201, 202, 203, 204, 206, 207, 208, 209, 210, 301, 302, 303, 304, 305, 306, 307, 401, 402, 403, 404, 405,
    406, 407, 408, 409, 410, 701, 702, 703, 704, 705, 706, 707, 708, 709, 710, 711, 712, 713, 714, 801, 802, 803,
    804, 805, 806, 807, 808, 809, 810, 811, 813, 901, 902, 904, 905, 906, 907, 908, 909, 910, 1001, 1004, 1005,
    1006, 1008, 1101, 1102, 1103, 1104, 1105, 1106, 1107, 1108, 1109, 1202, 1206, 1207, 1209, 1211, 1212, 1214,
    1301, 1302, 1501, 1502, 1504, 1507, 1508, 1509, 1510, 1511, 1512, 1513, 1514, 1515, 1516, 1517, 1518, 1601,
    1602, 1604, 1605, 1701, 1702, 1704, 1804, 1805, 1806, 1901, 1902, 1904, 1905, 2001, 2002, 2003, 2004, 2005,
    2006, 2007, 2008, 2009, 2101, 2102, 2103, 2104, 2105, 2106,
)

# Sector label by NAICS prefix, spelled as published.
NAICS_SECTORS = {
    "11": "Agrivultura, silvicultura, pesca y caza",
    "21": "Minería",
    "31": "Manufactura",
    "32": "Manufactura",
    "33": "Manufactura",
    "311": "Alimentos",
    "312": "Productos de bebidads y tabaco",
    "313": "Textiles",
    "314": "Textiles",
    "315": "Ropa",
    "316": "Cuero y productos  de afines",
    "321": "Productos de madera",
    "322": "Papel",
    "323": "Imprenta",
    "324": "Productos de petróleo y carbón",
    "325": "Químicos",
    "3254": "Farmacéuticos y medicinas",
    "326": "Productos de plástico y de goma",
    "327": "Productos minerales no metálicos",
    "331": "Metales primarios",
    "332": "productos fabricados de metal",
    "333": "Maquinaria",
    "334": "Equipo de computación y productos electrónicos",
    "3341": "Computadoras y equipo periférico",
    "335": "Equipo eléctrico, enseres, y componetes",
    "336": "Equipo de transporte",
    "337": "Muebles y productos relacionados",
    "339": "Manufacturas misceláneas",
    "3391": "Equipos y materiales de uso médico",
}


def _constant_table(spark: SparkSession, columns: str, rows: Iterable[str]) -> DataFrame:
    """Rows given as SQL text. They are part of the plan, so Spark knows their size."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({columns})")


def direction_table(spark: SparkSession) -> DataFrame:
    return _constant_table(spark, "id, trade", (f"({i}, {text_literal(n)})" for i, n in DIRECTION_NAMES.items()))


def agricultural_headings(spark: SparkSession) -> DataFrame:
    headings = _constant_table(spark, "heading", (f"({h})" for h in AGRICULTURAL_HEADINGS))
    return headings.selectExpr(f"{code_text('heading', 4)} AS hs4")


def naics_sectors(spark: SparkSession) -> DataFrame:
    rows = (f"('{prefix}', {text_literal(sector)})" for prefix, sector in NAICS_SECTORS.items())
    return _constant_table(spark, "prefix, sector", rows)


def with_agricultural_flag(df: DataFrame, code: str = "hts_code", flag: str = "agricultural") -> DataFrame:
    """1 when the heading is on the agricultural list, 0 when not, null without a code.

    A fixed set of 129 codes is a hash lookup inside the projection; no join is needed.
    """
    headings = ", ".join(f"'{h:04d}'" for h in AGRICULTURAL_HEADINGS)
    return df.withColumn(flag, F.expr(f"int({code_prefix(code, 4)} IN ({headings}))"))


# Above every character: codes that start with a prefix lie from it up to the prefix followed by this.
_HIGHEST = "\U0010FFFF"


def _swept(prefixes: Mapping[str, str]) -> list[tuple[str, str, str]]:
    """Nested prefixes as disjoint intervals (low, high, label) with the innermost label, by one sorted sweep."""
    ends = sorted([(p, p) for p in prefixes] + [(p + _HIGHEST, None) for p in prefixes])
    intervals, enclosing = [], []
    for (low, opened), (high, _) in pairwise(ends):
        if opened is not None:
            enclosing.append(opened)
        else:
            enclosing.pop()
        if enclosing and low < high:
            intervals.append((low, high, prefixes[enclosing[-1]]))
    return intervals


def _bounds(prefixes: DataFrame, shortest: int) -> DataFrame:
    """Where labels change along the codes, as `bucket, low, label`: codes from `low` up to the next bound of the bucket have the
    label, which is null behind the end of a prefix that no other goes on with.

    A label holds from where a prefix begins, or where one ends and the next shorter one goes on. It is found by looking up
    the leading parts of the bound.
    """
    labels = prefixes.where("prefix IS NOT NULL").groupBy("prefix").agg(F.min("label").alias("label"))
    bounds = labels.selectExpr(
        "prefix", f"inline(array(struct(prefix AS low, length(prefix) AS n), struct(concat(prefix, '{_HIGHEST}') AS low, length(prefix) - 1 AS n)))")
    parts = bounds.selectExpr(
        "prefix", "low", f"explode_outer(if(n < {shortest}, NULL, transform(sequence({shortest}, n), k -> left(prefix, k)))) AS part")
    found = parts.join(labels.selectExpr("prefix AS part", "label AS inner"), "part", "left")
    longest = found.groupBy("prefix", "low").agg(F.expr("max_by(inner, if(inner IS NULL, NULL, length(part)))").alias("label"))
    return longest.selectExpr(f"left(prefix, {shortest}) AS bucket", "low", "label")


def code_intervals(prefixes: DataFrame, shortest: int) -> DataFrame:
    """A table (prefix, label) of any size as disjoint intervals `low, high, label, bucket` of codes, each with the label of
    its longest prefix. The first of several labels of a prefix counts; `shortest` is the length of the shortest prefix.

    The end of an interval is the next bound in its bucket.
    """
    ahead = "lead(low) OVER (PARTITION BY bucket ORDER BY low)"
    return _bounds(prefixes, shortest).selectExpr("bucket", "low", f"{ahead} AS high", "label").where("label IS NOT NULL")


# Parts that the codes of a bucket are dealt to, each with all bounds of the bucket, so that a hot bucket, a hot code and
# rows without a code are not one task's.
_DEALT = 8


def _label_at_bounds(df: DataFrame, prefixes: DataFrame, code: str, label: str, shortest: int) -> DataFrame:
    """`with_prefix_label` for a table: codes and bounds in one order, and each code takes the label of the last bound before it.

    Each code is sorted once, however many prefixes its bucket has, and `df` is read once.
    """
    names = {c: unused_name(f"_{c}", df) for c in ("bucket", "dealt", "at", "is_code", "found")}
    bucket, dealt, at, is_code, found = names.values()
    # Maps have no hash; a row's part decides only where it is labelled.
    hashed = ", ".join(quoted(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind)
    value = f"string({quoted(code)})"
    codes = df.selectExpr(
        "*", f"left({value}, {shortest}) AS {bucket}", f"int(pmod(xxhash64({hashed}), {_DEALT})) AS {dealt}", f"{value} AS {at}", f"true AS {is_code}")
    bounds = _bounds(prefixes, shortest).selectExpr(
        f"bucket AS {bucket}", f"explode(sequence(0, {_DEALT - 1})) AS {dealt}", f"low AS {at}", f"false AS {is_code}",
        f"struct(label) AS {found}")
    # The label of a bound may be null and counts, too; rows of codes have no struct and are passed over.
    last = f"last({found}, true) OVER (PARTITION BY {bucket}, {dealt} ORDER BY {at}, {is_code} ROWS UNBOUNDED PRECEDING)"
    labelled = codes.unionByName(bounds, allowMissingColumns=True).withColumn(found, F.expr(last)).where(is_code)
    return labelled.withColumn(label, F.col(f"{found}.label")).drop(*names.values())


def with_prefix_label(
    df: DataFrame, prefixes: Mapping[str, str] | DataFrame, code: str, label: str, shortest: int | None = None
) -> DataFrame:
    """Label of the longest listed prefix of a code; null when no prefix is listed.

    `prefixes` is a mapping, or a table (prefix, label) for a classification of any size. Codes are dealt by their first
    `shortest` characters (the length of the shortest prefix; found by a small job if not given). Prefixes of a mapping become
    disjoint intervals, and one join finds the code's, with the bounds as its condition: a code is compared with the
    intervals of its bucket, which the mapping limits, and matches at most one. With a table, codes are sorted among the
    bounds of their bucket, so the work grows with codes and prefixes and not with their product.
    """
    if isinstance(prefixes, DataFrame):
        if shortest is None:
            shortest = prefixes.agg(F.min(F.length("prefix"))).first()[0] or 1
        return _label_at_bounds(df, prefixes, code, label, shortest)
    shortest = min(map(len, prefixes), default=1)
    rows = [f"({', '.join(map(text_literal, (low[:shortest], low, high, name)))})" for low, high, name in _swept(prefixes)]
    intervals = _constant_table(df.sparkSession, "bucket, low, high, label", rows or ["('', '', '', '')"])
    names = {c: unused_name(f"_{c}", df) for c in ("bucket", "low", "high", "label")}
    intervals = intervals.select(*(F.col(c).alias(name) for c, name in names.items()))
    value = quoted(code)
    within = f"left({value}, {shortest}) = {names['bucket']} AND {value} >= {names['low']} AND {value} < {names['high']}"
    joined = df.join(intervals, F.expr(within), "left")
    return joined.withColumn(label, F.col(names["label"])).drop(*names.values())


def with_naics_sector(df: DataFrame, code: str = "naics", label: str = "sector") -> DataFrame:
    """Label of the longest listed prefix of the NAICS code; null when no prefix is listed."""
    return with_prefix_label(df, NAICS_SECTORS, code, label)


# Dimension of each key of the star-schema facts.
STAR_KEYS = {
    "country_id": "country", "unit1_id": "unit", "unit2_id": "unit", "sitc_id": "sitc", "naics_id": "naics",
    "district_id": "district", "hts_id": "hts",
}

# What each look-up brings, by key.
_LOOKED_UP = {
    "country_id": {"country": "country_name"}, "unit1_id": {"unit_1": "unit_code"}, "unit2_id": {"unit_2": "unit_code"},
    "sitc_id": {"sitc": "sitc_code"}, "naics_id": {"naics": "naics_code"}, "district_id": {"district": "district_desc"},
    "hts_id": {"hts_code": "hts_code", "hts_desc": "hts_short_desc", "agri_prod": "int(agri_prod)"},
}

_LEVEL_KEYS = {"hts": "hts_id", "naics": "naics_id", "country": "country_id"}


# True for every key that a dimension has; as a second join key it deals rows without a key to all tasks. The right side is 0,
# written so that the optimizer keeps it as a key.
_SPREAD = "if({key} IS NULL, hash(date, data), 0) = pmod(hash(_{key}), 1)"


def denormalise(fact: DataFrame, dimensions: dict[str, DataFrame], level: str = "total", level_filter: str = "") -> DataFrame:
    """Star-schema fact to the flat planning-board shape, plus the names of direction and district.

    `dimensions` holds the tables `country, hts, sitc, naics, district, unit` by their contracts; the two directions are
    fixed and need none. A key without a match gives nulls and keeps the row. There are no broadcast hints: Spark
    broadcasts a dimension when its size is below the threshold and otherwise sorts and merges, where adaptive execution
    splits a key that holds much of the fact. Products, the largest dimension, come last: should only they exceed
    the threshold, the fact is shuffled once, with its other names already in place. Rows without a key, which match nothing,
    are dealt by their values, as hashing would send them all to one task.

    With a `level` ("hts", "naics", "country") only records whose code starts with `level_filter` are returned. Then that
    dimension is filtered first and joined before all others, so the rest of the fact is never looked up; where the
    filtered keys are few, they reach the fact's scan as a runtime filter or a broadcast.
    """
    keys = [k for k in STAR_KEYS if k in fact.columns]
    selective = _LEVEL_KEYS.get(level)
    if selective is not None:
        if selective not in keys:
            raise ValueError(f"level {level!r} needs the column {selective!r}, which this source does not have")
        keys = [selective, *(k for k in keys if k != selective)]
    flat = fact
    for key in keys:
        columns = _LOOKED_UP[key]
        side = dimensions[STAR_KEYS[key]]
        if key == selective:
            side = side.where(starts_with(columns[LEVEL_COLUMNS[level]], level_filter))
        side = side.selectExpr(f"id AS _{key}", *(f"{c} AS {alias}" for alias, c in columns.items()))
        found = f"{key} = _{key}" if key == selective else f"{key} = _{key} AND {_SPREAD.format(key=key)}"
        flat = flat.join(side, F.expr(found), "inner" if key == selective else "left").drop(f"_{key}")
    names = " ".join(f"WHEN {i} THEN {text_literal(n)}" for i, n in DIRECTION_NAMES.items())
    flat = flat.withColumn("direction", F.expr(f"CASE trade_id {names} END"))
    return flat.select(
        "date", "country", "trade_id", "agri_prod", "hts_code", "hts_desc", "data", "unit_1", "qty_1", "unit_2",
        "qty_2", "direction", *(("sitc", "naics", "district") if "sitc_id" in fact.columns else ()),
    )


def unmatched_keys(fact: DataFrame, dimensions: dict[str, DataFrame], keys: Mapping[str, str] = STAR_KEYS) -> DataFrame:
    """field, dimension, key, records: keys of a fact that their dimension lacks, null keys included, with the number of records that hold them.

    One scan of the fact: its keys become rows, which are counted on the map side, so a key of many rows costs one row per
    task; only distinct keys meet the dimensions.
    """
    used = {k: d for k, d in keys.items() if k in fact.columns and d in dimensions}
    if not used:
        raise ValueError("the fact has no key of these dimensions")
    each = ", ".join(
        f"struct({text_literal(k)} AS field, {text_literal(d)} AS dimension, bigint({quoted(k)}) AS key)" for k, d in used.items())
    counted = fact.selectExpr(f"inline(array({each}))").groupBy("field", "dimension", "key").agg(F.count(F.lit(1)).alias("records"))
    known = [dimensions[d].selectExpr(f"{text_literal(d)} AS dimension", "bigint(id) AS key") for d in sorted(set(used.values()))]
    ids = known[0]
    for more in known[1:]:
        ids = ids.unionByName(more)
    return counted.join(ids, ["dimension", "key"], "left_anti").select("field", "dimension", "key", "records")
