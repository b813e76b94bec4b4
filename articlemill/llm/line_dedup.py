"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

Two lines are near if one edit (a character put in, taken out or replaced) makes them
equal. Near lines share a variant: the shorter is the longer without one character, and lines of
one length agree without the character at one place. So lines emit hashes of their variants,
equal hashes meet, and the edit distance of those that met is verified. In a group of equal
variants each line is held against one other only, the earliest (or against the line that *is* the
variant), which is exact at this bound; so no pairs within a group are listed.

Variants are many, so only lines that can have a partner emit them, and only for places
where the edit can be: one edit leaves one half of the line as it was, thus lines are first
counted by hashes of their halves.

A line is dropped if an equal or near line stands earlier (by key, then by place), whether or
not that one is dropped itself. Lines of fewer than `min_chars` characters always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from articlemill.llm.common import stored

MIN_CHARS = 16
#: Lines up to which their places are broadcast to pick their texts; beyond, all lines are shuffled by place.
BROADCAST_ROWS = 300_000
PLACE = ["no_key", "key", "text_hash", "pos"]


def document_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row per line. Texts of one key are told apart by a hash, and equal rows are one document."""
    named = docs.select(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text_hash"), F.split(F.col(text), "\n").alias("lines"))
    return named.select("no_key", "key", "text_hash", F.posexplode("lines").alias("pos", "line"))


def half_keys(line: Column, n: Column) -> Column:
    """`(hash, role, half)`: what a line shares with a line of n - 1, n or n + 1 characters one edit away.

    For lengths m <= M with M - m <= 1 the first M // 2 characters agree, or the last M - M // 2.
    """
    roles = []
    for role, shorter, longer in (("same", n, n), ("short", n, n + 1), ("long", n - 1, n)):
        cut = F.floor(longer / 2).cast("int")
        for half, part in (("first", F.left(line, cut)), ("last", F.right(line, longer - cut))):
            shared = F.xxhash64(shorter, longer, F.lit(half), part)
            roles.append(F.struct(shared.alias("half_hash"), F.lit(role).alias("role"), F.lit(half).alias("half")))
    return F.array(*roles)


def line_classes(lines: DataFrame, min_chars: int) -> DataFrame:
    """Distinct lines by two hashes, with the place of the earliest and the hashes of the halves.

    Copies of a line combine in each task before the shuffle, which holds no texts.
    """
    long = lines.withColumn("n", F.length("line")).filter(F.col("n") >= min_chars)
    hashed = long.select(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.reverse("line")).alias("h2"),
        F.struct(*PLACE).alias("first"), half_keys(F.col("line"), F.col("n"))["half_hash"].alias("halves"),
    )
    return hashed.groupBy("h1", "h2", "halves").agg(F.min("first").alias("first"))


def with_partners(classes: DataFrame) -> DataFrame:
    """`(h1, roles)`: lines that share a half with another line, and in which roles."""
    named = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(h).alias("half")) for r in ("same", "short", "long") for h in ("first", "last")])
    halves = classes.select("h1", F.explode(F.arrays_zip(F.col("halves"), named.alias("as"))).alias("x"))
    halves = halves.select("h1", F.col("x.halves").alias("half_hash"), F.col("x.as.role").alias("role"), F.col("x.as.half").alias("half"))
    met = halves.groupBy("half_hash").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low < high")
    return halves.join(met.select("half_hash"), "half_hash", "left_semi").groupBy("h1").agg(F.collect_set(F.struct("role", "half")).alias("roles"))


def variants(line: Column, n: Column, role: Column, half: Column) -> Column:
    """`(kind, at, v1, v2)` of every variant in one role: the line less one character of the half that may differ."""
    cut = F.floor(n / 2).cast("int")
    places = F.when(half == "first", F.sequence(cut, n - 1)).otherwise(F.sequence(F.lit(0), cut - 1))

    def hashed(kind: Column, at: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), at.alias("at"), F.xxhash64(text).alias("v1"), F.hash(text, F.lit(7)).alias("v2"))

    def without(p: Column) -> Column:
        return F.concat(F.left(line, p), line.substr(p + 2, n))

    replaced = F.transform(places, lambda p: hashed(F.lit(0), p, without(p)))
    taken_out = F.transform(places, lambda p: hashed(F.lit(1), F.lit(-1), without(p)))
    itself = F.array(hashed(F.lit(1), F.lit(-1), line))
    return F.when(role == "same", replaced).when(role == "long", taken_out).otherwise(itself)


def near_lines(classes: DataFrame, lines: DataFrame) -> DataFrame:
    """`(h1, h2)` of lines that have an earlier line one edit away."""
    named = stored(classes.join(with_partners(classes), "h1").select("h1", "h2", "first.*", "first", "roles"), "partners")
    side = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    on = [lines[c].eqNullSafe(side[c]) for c in PLACE]
    texts = lines.join(side, on).select("h1", "h2", "first", "roles", "line").dropDuplicates(["h1", "h2"])
    texts = stored(texts, "lines")
    n = F.length("line")
    roles = texts.select("h1", "h2", "first", "line", F.explode("roles").alias("r")).withColumn("whole", F.col("r.role") == "short")
    emitted = roles.select("h1", "h2", "first", "whole", F.explode(variants(F.col("line"), n, F.col("r.role"), F.col("r.half"))).alias("v"))
    emitted = emitted.select("h1", "h2", "first", "whole", "v.*")
    group = W.partitionBy("kind", "at", "v1", "v2")
    me = F.struct("first", "h1", "h2")
    hub = F.min(F.when(F.col("whole"), me)).over(group)
    spoke = F.min(F.when(~F.col("whole"), me)).over(group)
    # Of one length: the earliest of all. Else: the variant itself for the longer lines, the earliest of these for it.
    earlier = F.when((F.col("kind") == 1) & ~F.col("whole"), hub).otherwise(spoke)
    met = emitted.withColumn("earlier", earlier).filter(F.col("earlier.first") < F.col("first"))
    pairs = met.select("h1", "h2", F.col("earlier.h1").alias("e1"), F.col("earlier.h2").alias("e2")).distinct()
    other = texts.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("earlier_line"))
    verified = pairs.join(texts.select("h1", "h2", "line"), ["h1", "h2"]).join(other, ["e1", "e2"])
    distance = F.levenshtein("line", "earlier_line", 1)
    return verified.filter(distance.between(0, 1)).select("h1", "h2").distinct()


def kept_places(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """`(no_key, key, text_hash, places)`: places of the lines of `min_chars` or more that stay, where there are any."""
    lines = document_lines(docs, key, text)
    classes = stored(line_classes(lines, min_chars), "classes")
    kept = classes.join(near_lines(classes, lines), ["h1", "h2"], "left_anti").select("first.*")
    return kept.groupBy("no_key", "key", "text_hash").agg(F.collect_list("pos").alias("places"))


def short_places(text: Column, min_chars: int) -> Column:
    """The places of lines that are too short to be compared."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.when(F.length(x) < min_chars, i)), lambda p: p.isNotNull())


def with_places(rows: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Adds `_kept`, the ascending places of all lines that stay, to rows with `_hash` and `_short`."""
    joined = rows.join(kept, rows[key].eqNullSafe(kept["key"]) & (rows["_hash"] == kept["text_hash"]), "left")
    none = F.array().cast("array<int>")
    return joined.withColumn("_kept", F.array_sort(F.concat(F.coalesce("_short", none), F.coalesce("places", none))))


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """`(key, n_lines, n_kept, kept_sha256)` of each row: lines are parts between line feeds.

    The digest is that of the places of kept lines, from 0, joined by commas. A null text has no
    lines; an empty one has one, which is short. Equal rows are one document and keep the same lines.
    """
    kept = kept_places(docs, key, text, min_chars)
    n = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n")))
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_hash"), n.alias("n"), short_places(F.col(text), min_chars).alias("_short"))
    return with_places(rows, kept, "_key").select(
        F.col("_key").alias(key), F.col("n").cast("bigint").alias("n_lines"), F.size("_kept").cast("bigint").alias("n_kept"),
        F.sha2(F.array_join(F.col("_kept").cast("array<string>"), ","), 256).alias("kept_sha256"),
    )


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with only the lines that stay; those of which nothing but blanks stays are dropped.

    A document whose text is null, or blank from the start, is left as it is. All other columns, and the
    order of columns, stay; a column that counts the text is not changed.
    """
    kept = kept_places(docs, key, text, min_chars)
    names = docs.columns
    moved = docs.toDF(*[f"_own_{i}" for i in range(len(names))])
    own_key, own_text = f"_own_{names.index(key)}", f"_own_{names.index(text)}"
    was_blank = F.coalesce(~F.col(own_text).rlike(r"\S"), F.lit(True))
    rows = moved.select(
        *[c for c in moved.columns if c != own_text], F.xxhash64(own_text).alias("_hash"), was_blank.alias("_blank"),
        F.split(F.col(own_text), "\n").alias("_lines"), short_places(F.col(own_text), min_chars).alias("_short"),
    )
    joined = with_places(rows, kept, own_key)
    places = F.col("_kept")
    rebuilt = F.when(F.col("_lines").isNotNull(), F.array_join(F.transform(places, lambda p: F.get("_lines", p)), "\n"))
    done = joined.withColumn(own_text, rebuilt).filter(F.col("_blank") | F.col(own_text).rlike(r"\S"))
    return done.select(*[F.col(f"_own_{i}").alias(c) for i, c in enumerate(names)])
