"""Removal of repeated passages by content-defined chunks of lines. DataFrame functions only.

A text is cut into lines, and lines at the ends of sentences, so that a passage of one long line has several. A rolling
hash over every two lines that follow each other is compared with its neighbours: a chunk begins where it is no larger
than either. Where chunks begin depends on the lines around alone and comes back after text is put in or taken out.

A chunk is known by its first two lines. One that begins as an earlier chunk does is aligned with where that stands
first; lines are then compared by their bytes there, and every stretch of equal lines around the beginning goes. Hashes
only say where to compare. One that two different pairs of lines share costs a comparison and removes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import packed, stored

#: A repeated stretch has at least two lines and so many characters.
LEAST_CHARS = 40
#: Lines by which a stretch may reach beyond the outermost chunks that began alike.
REACH = 8


def _hard(x: Column) -> Column:
    """An expression that Catalyst does not copy into others before it has found the condition always true. It then may join
    projections again, so that rows with long arrays are not held once for each."""
    return F.when(F.rand(1) >= 0, x)


def _once(x: Column) -> Column:
    """An expression that Catalyst never copies into filters and lambdas, where it would be computed again and again: the
    always true condition counts as random and is not folded."""
    return F.when(F.rand(1) + 1 > 0, x)


def _grouped(frame: DataFrame, values: str, alike: Callable[[Column, Column], Column], made: Callable[[Column], Column], name: str) -> DataFrame:
    """Adds ``name``: of each group of neighbours that are ``alike`` in the sorted array ``values``, what is ``made`` of its part."""
    begins = F.filter(F.sequence(F.lit(0), F.size(values) - 1), lambda i: (i == 0) | ~alike(F.get(values, i), F.get(values, i - 1)))
    frame = frame.withColumn("_begins", _once(begins))
    part = lambda i, k: F.slice(values, i + 1, F.coalesce(F.get("_begins", k + 1), F.size(values)) - i)
    return frame.withColumn(name, F.transform("_begins", lambda i, k: made(part(i, k)))).drop("_begins")


#: Where a text is cut: at line ends, and at the blank after a sentence.
_CUT = r"\n| (?<=[.!?…] )(?=\S)"


def bodies(text: Column) -> Column:
    """The bodies of ``with_units`` alone, at less cost."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), _CUT), lambda x: F.trim(x))


def with_units(frame: DataFrame, text: Column) -> DataFrame:
    """Adds ``units``: an array of (line, nth, unit, body) in order; the units put together are the text.

    A unit is a sentence or what else lies between line ends and sentence ends; it starts with the line end or
    blank that parts it from the unit before, its body has no blanks around it. Null and empty texts have one unit without characters.
    """
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    mark = lambda j, k: F.when(k > 0, " ").when(j > 0, "\n").otherwise("")
    unit = lambda j: lambda x, k: F.struct(j.alias("line"), k.alias("nth"), F.concat(mark(j, k), x).alias("unit"), F.trim(x).alias("body"))
    units = F.flatten(F.transform(lines, lambda x, j: F.transform(F.split(x, r" (?<=[.!?…] )(?=\S)"), unit(j))))
    return frame.withColumn("units", _hard(units))


def _key(order: list[str], text: str) -> Column:
    nulls_last = [x for c in order for x in (F.col(f"`{c}`").isNull().alias(f"no_{c}"), F.col(f"`{c}`").alias(c))]
    return F.struct(*nulls_last, F.xxhash64(F.col(f"`{text}`")).alias("text_hash"))


def chunk_heads(frame: DataFrame, order: list[str], text: str = "text", together: DataFrame | None = None) -> DataFrame:
    """(party, key, at, ats, h, g): for each document and each pair of first lines of its chunks, known by their hashes h and g,
    all places where chunks begin so, in order, and the first of them.

    The key is (order columns, hash of the text): rows that agree in these are one document. ``party`` is what
    ``together`` (text_hash, party) says of the text's hash; texts that it does not name, and all without it, have none.
    """
    docs = frame.select(_key(order, text).alias("key"), bodies(F.col(f"`{text}`")).alias("bodies"))
    docs = docs.select("key", _once(F.transform("bodies", lambda x: F.xxhash64(x))).alias("hs"))
    # rolling[i - 1] is the hash over the lines i - 1 and i
    n = F.size("hs")
    rolling = F.zip_with(F.slice("hs", F.lit(1), n - 1), F.slice("hs", F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b))
    docs = docs.select("key", "hs", _once(rolling).alias("rolling"))
    low = lambda i, j: F.get("rolling", i - 1) <= F.coalesce(F.get("rolling", j), F.get("rolling", i - 1))
    begins = F.filter(F.sequence(F.lit(0), n - 2), lambda i: (i == 0) | (low(i, i - 2) & low(i, i)))
    docs = docs.where(n > 1).select("key", "hs", _once(begins).alias("begins"))
    heads = F.sort_array(F.transform("begins", lambda i: F.struct(F.get("hs", i).alias("h"), F.get("hs", i + 1).alias("g"), i.alias("at"))))
    party = F.lit(None).cast("long")
    if together is not None:
        # hashes and few numbers a document move here, not its text; rows are made after it, as arrays of structs are slow to unnest
        parties = together.select(F.col("text_hash").alias("th"), "party")
        docs, party = docs.join(parties, F.col("key.text_hash") == F.col("th"), "left"), F.col("party")
    # lines that a document repeats again and again give one row with all their places
    docs = docs.select(party.alias("party"), "key", _once(heads).alias("heads"))
    docs = _grouped(docs, "heads", lambda x, y: (x["h"] == y["h"]) & (x["g"] == y["g"]), lambda part: F.struct(F.get(part, F.lit(0)).alias("head"), part["at"].alias("ats")), "groups")
    found = docs.select("party", "key", F.explode("groups").alias("x"))
    return found.select("party", "key", "x.head.at", "x.ats", "x.head.h", "x.head.g")


def alignments(frame: DataFrame, order: list[str], text: str = "text", together: DataFrame | None = None) -> DataFrame:
    """(key, compared): for each document and each earlier one, an array of the stretches (low, ats, lines) to compare.

    ``lines`` are the bodies of the other document from the line on that should equal line ``low``; ``ats`` are the lines
    where chunks began alike.
    """
    heads = stored(chunk_heads(frame, order, text, together), "heads")
    place = lambda at: F.struct("party", "key", at.alias("at"))
    # one row for each beginning, with its first place: hot ones shrink before they are shuffled
    first = heads.groupBy("h", "g").agg(F.min(place(F.col("at"))).alias("first"), F.max(place(F.element_at("ats", -1))).alias("last")).where("first <> last")
    # stored, so that the join has two plain sides and adaptive execution may split a hot beginning
    first = stored(first.select("h", "g", "first"), "firsts")
    # a document asks once for each beginning, however often it stands there; the first place itself is not compared
    own = F.struct("party", "key") == F.struct("first.party", "first.key")
    later = heads.join(first, ["h", "g"]).where(~own | (F.size("ats") > 1))
    if together is not None:
        later = later.where((F.col("party") == F.col("first.party")).isNull() | (F.col("party") != F.col("first.party")))
    ats = F.when(own, F.slice("ats", F.lit(2), F.size("ats") - 1)).otherwise(F.col("ats"))
    # a place and the distance to its first place are one number, sorted by the distance
    codes = F.transform(ats, lambda at: (F.col("first.at") - at).cast("long") * (1 << 32) + at)
    shift = lambda c: F.shiftright(c, 32).cast("int")
    at = lambda c: c.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    low = lambda c: F.greatest(F.lit(0), -shift(c), at(c) - REACH)
    stretch = lambda part: F.struct(
        shift(F.get(part, F.lit(0))).alias("shift"),
        low(F.get(part, F.lit(0))).alias("low"),
        (at(F.element_at(part, -1)) + 2 + REACH).alias("high"),
        F.transform(part, at).alias("ats"),
    )
    # a document meets another once, however many stretches they share
    aligned = later.select("key", F.col("first.key").alias("other"), codes.alias("codes")).groupBy("key", "other").agg(F.collect_list("codes").alias("codes"))
    aligned = aligned.select("key", "other", _once(F.sort_array(F.array_distinct(F.flatten("codes")))).alias("codes"))
    aligned = _grouped(aligned, "codes", lambda x, y: shift(x) == shift(y), stretch, "stretches")
    aligned = stored(aligned.select("key", "other", "stretches"), "alignments")
    others = frame.select(_key(order, text).alias("other"), F.col(f"`{text}`").alias("text"))
    others = others.join(aligned.select("other").distinct(), "other", "left_semi").dropDuplicates(["other"])
    others = others.select("other", bodies(F.col("text")).alias("bodies"))
    met = aligned.join(stored(others, "others"), "other")
    lines = lambda x: F.slice("bodies", x["low"] + x["shift"] + 1, x["high"] - x["low"])
    return met.select("key", F.transform("stretches", lambda x: F.struct(x["low"].alias("low"), x["ats"].alias("ats"), lines(x).alias("lines"))).alias("compared"))


def _repeated(compared: str, units: str) -> list[tuple[str, Column]]:
    """Columns, one after the other, that end with ``gone``: the numbers of the units that go."""
    differs = lambda a: F.filter(
        F.sequence(F.lit(0), F.size(a["lines"]) - 1),
        lambda k: ~F.get(units, a["low"] + k)["body"].eqNullSafe(F.get(a["lines"], k)),
    )
    narrow = F.transform(compared, lambda a: F.struct(a["low"].alias("low"), a["ats"].alias("ats"), a["lines"].alias("lines"), differs(a).alias("differs")))
    # a stretch is kept as one number: its begin and its end among the lines compared
    equal = lambda a, x: ~F.array_contains(a["differs"], x - a["low"]) & ~F.array_contains(a["differs"], x + 1 - a["low"])
    begin = lambda a, x: F.coalesce(F.array_max(F.filter(a["differs"], lambda z: z < x - a["low"])), F.lit(-1)) + 1
    end = lambda a, x: F.coalesce(F.array_min(F.filter(a["differs"], lambda z: z > x - a["low"])), F.size(a["lines"]))
    code = lambda a: lambda x: begin(a, x).cast("long") * (1 << 31) + end(a, x)
    runs = F.transform(
        "narrow",
        lambda a: F.struct(a["low"].alias("low"), a["lines"].alias("lines"), F.array_distinct(F.transform(F.filter(a["ats"], lambda x: equal(a, x)), code(a))).alias("runs")),
    )
    of = lambda c: F.shiftright(c, 31).cast("int")
    to = lambda c: (c % (1 << 31)).cast("int")
    enough = lambda a: lambda c: F.length(F.array_join(F.slice(a["lines"], of(c) + 1, to(c) - of(c)), "\n")) >= LEAST_CHARS
    numbers = lambda a: F.flatten(F.transform(F.filter(a["runs"], enough(a)), lambda c: F.sequence(a["low"] + of(c), a["low"] + to(c) - 1)))
    gone = F.array_distinct(F.flatten(F.transform("runs", numbers)))
    return [("narrow", narrow), ("runs", runs), ("gone", gone)]


def dedup_lines(frame: DataFrame, order: list[str] | None = None, text: str = "text", together: DataFrame | None = None) -> DataFrame:
    """The frame with repeated passages cut out of ``text``, and new columns n_removed (units) and removed_chars.

    Of each beginning of a chunk (two lines) the first place in the table counts; every other one is compared with it,
    and the stretch of equal lines around it goes if it has LEAST_CHARS. A stretch reaches over whole chunks that began
    alike at the same distance and REACH lines beyond. What goes is equal to lines that stand earlier, so the first
    place of every line stays.

    ``order`` names the columns by which the first place is found (``doc_id`` unless given; null comes last). ``together``
    (text_hash, party) puts texts, by their xxhash64, into parties that shall not cut each other; a party's number goes
    before the order. Rows that agree in the
    order columns and in the text count as one document and come out alike. A null text stays null and an empty one empty. What
    repeats within a document counts as repeated too. A text of one line stays. Other columns pass; columns named n_removed or
    removed_chars are replaced. An empty table gives an empty table.
    """
    order = order or ["doc_id"]
    compared = alignments(frame, order, text, together).groupBy("key").agg(F.flatten(F.collect_list("compared")).alias("compared"))
    docs = frame.select(packed(frame), _key(order, text).alias("key")).join(compared, "key", "left")
    # only documents that have something to compare are cut again
    whole = F.col("row").getField(text)
    docs = with_units(docs.withColumn("cut", F.when(F.col("compared").isNotNull(), whole)), F.col("cut"))
    for name, column in _repeated("compared", "units"):
        docs = docs.withColumn(name, _hard(column))
    docs = docs.withColumn("gone", _hard(F.when(F.size("gone") > 0, F.col("gone"))))
    stay = F.transform(F.array_except(F.sequence(F.lit(0), F.size("units") - 1), "gone"), lambda i: F.get("units", i))
    docs = docs.withColumn("stay", _hard(stay))
    # what is left of a line whose start is gone stands in a line of its own
    again = lambda x, m: F.when((m > 0) & (x["nth"] > 0) & (F.get("stay", m - 1)["line"] != x["line"]), F.concat(F.lit("\n"), F.ltrim(x["unit"]))).otherwise(x["unit"])
    left = F.array_join(F.transform("stay", again), "")
    left = F.when(F.array_contains("gone", 0), F.regexp_replace(left, r"\A\s+", "")).otherwise(left)
    docs = docs.withColumn("left", F.when(F.col("gone").isNotNull(), F.when(F.trim(left, F.lit(" \t\r\n")) == "", F.lit("")).otherwise(left)).otherwise(whole))
    lost = F.coalesce(F.length(whole) - F.length("left"), F.lit(0))
    columns = [F.col("left").alias(text) if c == text else F.col("row").getField(c).alias(c) for c in frame.columns if c not in ("n_removed", "removed_chars")]
    return docs.select(*columns, F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"), lost.alias("removed_chars"))
