"""Document fingerprints: Merkle trees over pieces, paragraphs and sections, in DataFrame functions only.

A text is cut without loss into sections (at blank lines), these into paragraphs (lines), these
into pieces (sentences, at most 64 characters beside the closing marks). Each piece has a digest;
a paragraph's digest is taken over its pieces' digests, a section's over its paragraphs', the root
over the sections'. Equal roots mean equal texts; where roots differ, only branches that differ need
to be followed to find the edit.

As text a fingerprint is ``root|section;section...``, a section ``digest:paragraph,paragraph...`` and
a paragraph ``digest`` followed by its pieces' digests, 8 characters each.

Defined cases: a null text counts as empty and has a root and no section; repeated ids are ordered
by a hash of their text; rows with a null id come last; a single row is followed by itself.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SECTIONS = r"(?s).+?(?:\n[ \t]*\n\s*|\z)"
_PARAGRAPHS = r"[^\n]*\n|[^\n]+"
_PIECES = r"[^.!?\n]{0,64}[.!?\n]+|[^.!?\n]{1,64}"
_SHOWN = 8
#: Ranges of ids per shuffle partition; more of them even out the partitions.
_RANGES = 8


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def tree(text: Column) -> Column:
    """Sections of a text as ``struct(digest, paragraphs array<struct(digest, pieces)>)``."""

    def paragraph(p: Column) -> Column:
        pieces = F.transform(_all(p, _PIECES), lambda x: F.sha2(x, 256))
        return F.struct(
            F.sha2(F.array_join(pieces, ""), 256).alias("digest"),
            F.transform(pieces, lambda d: F.substring(d, 1, _SHOWN)).alias("pieces"),
        )

    def section(s: Column) -> Column:
        return F.transform(_all(s, _PARAGRAPHS), paragraph)

    paragraphs = F.transform(_all(F.coalesce(text, F.lit("")), _SECTIONS), section)
    return F.transform(
        paragraphs,
        lambda ps: F.struct(
            F.sha2(F.array_join(F.transform(ps, lambda p: p["digest"]), ""), 256).alias("digest"), ps.alias("paragraphs")
        ),
    )


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(F.transform(sections, lambda s: s["digest"]), ""), 256)


def shown(sections: Column) -> Column:
    """The tree as one string."""
    paragraph = lambda p: F.concat(F.substring(p["digest"], 1, _SHOWN), F.array_join(p["pieces"], ""))
    section = lambda s: F.concat(
        F.substring(s["digest"], 1, _SHOWN), F.lit(":"), F.array_join(F.transform(s["paragraphs"], paragraph), ",")
    )
    return F.concat(root(sections), F.lit("|"), F.array_join(F.transform(sections, section), ";"))


def pieces(sections: Column) -> Column:
    """The distinct digests of all pieces."""
    return F.array_distinct(F.flatten(F.flatten(F.transform(sections, lambda s: s["paragraphs"]["pieces"]))))


def likeness(left: Column, right: Column) -> Column:
    """Twice the shared pieces over the pieces of both: 1 for equal sets, 0 without a common piece."""
    both = F.size(left) + F.size(right)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(left, right)) / both)


def differing(left: Column, right: Column) -> Column:
    """Places ``(section, paragraph)``, from 0, of the left tree's paragraphs that the right tree lacks.

    A section that the right tree holds too is passed over as a whole.
    """
    known_sections = F.transform(right, lambda s: s["digest"])
    known = F.flatten(F.transform(right, lambda s: s["paragraphs"]["digest"]))

    def inside(s: Column, i: Column) -> Column:
        places = F.transform(
            s["paragraphs"],
            lambda p, j: F.when(~F.array_contains(known, p["digest"]), F.struct(i.alias("section"), j.alias("paragraph"))),
        )
        return F.when(F.array_contains(known_sections, s["digest"]), F.array_compact(F.slice(places, 1, 0))).otherwise(
            F.array_compact(places)
        )

    return F.flatten(F.transform(left, inside))


_LONG = (1 << 63) - 1


def _range_of(key: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many bounds lie below the key ``(i, t)``, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    given = F.array(*[F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(t).cast("bigint").alias("t")) for i, t in bounds])

    def step(low: Column, size: Column) -> Column:
        fits = (low + size <= len(bounds)) & (F.get(given, low + size - 1) < key)
        return F.when(fits, low + size).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def _bounds(found: list[int]) -> list[tuple[int, int]]:
    """Upper ends ``(id, hash)`` of the ranges from quantiles of the ids. An id that is several quantiles is cut by hash."""
    out: set[tuple[int, int]] = set()
    for number, times in Counter(found).items():
        if times > 1:
            out.add((number - 1, _LONG))
            out.update((number, (j << 64) // times - _LONG - 1) for j in range(1, times))
        out.add((number, _LONG))
    return sorted(b for b in out if b[0] >= -_LONG - 1)


def with_next(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, text, next_text``: the text of the next row in descending order of ids; the first follows the last.

    Rows are cut into many ranges by approximate quantiles of their ids, and an id that many rows share by
    the hash of the text too, by which such rows are ordered. Each range is ordered by itself,
    and the head of the range below is added to its end. Only the bounds and one key per range come
    to the driver.
    """
    spark = documents.sparkSession
    ranges = ranges or _RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("doc_id", shares).alias("q")).first()["q"] if shares else None
    key = F.struct(F.col("doc_id").alias("i"), F.col("tie").alias("t"))
    placed = rows.withColumn("tie", F.xxhash64("text")).withColumn("part", _range_of(key, _bounds(found or [])))
    heads = sorted(((r["part"], r["top"]) for r in placed.groupBy("part").agg(F.max(key).alias("top")).collect()), key=lambda r: r[0])
    followed = [(heads[i][0], heads[i - 1][1].i, heads[i - 1][1].t) for i in range(len(heads))]
    targets = F.broadcast(spark.createDataFrame(followed, "target int, top bigint, top_tie bigint"))  # one row per range
    copies = (
        placed.join(targets, F.col("doc_id").eqNullSafe(F.col("top")) & (F.col("tie") == F.col("top_tie")))
        .groupBy("target")
        .agg(F.max("text").alias("text"))
        .select(
            F.lit(None).cast("bigint").alias("doc_id"),
            "text",
            F.lit(None).cast("bigint").alias("tie"),
            F.col("target").alias("part"),
            F.lit(1).alias("copy"),
        )
    )
    order = Window.partitionBy("part").orderBy("copy", F.desc_nulls_last("doc_id"), F.desc("tie"), F.desc("text"))
    both = placed.withColumn("copy", F.lit(0)).unionByName(copies)
    return both.withColumn("next_text", F.lead("text").over(order)).where("copy = 0").select("doc_id", "text", "next_text")


def compare_with_edit(documents: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit, whose last third comes from the next text."""
    third = F.floor(F.length("text") / 3).cast("int")
    kept = F.expr("left(text, length(text) - cast(floor(length(text) / 3) AS int))")
    edited = with_next(documents).withColumn("edited", F.concat(kept, F.when(third > 0, F.expr("left(next_text, cast(floor(length(text) / 3) AS int))")).otherwise("")))
    trees = edited.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own"),
        tree(F.col("edited")).alias("other"),
        pieces(tree(F.col("next_text"))).alias("next_pieces"),
    )
    with_pieces = trees.withColumns({"own_pieces": pieces(F.col("own")), "other_pieces": pieces(F.col("other"))})
    return with_pieces.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(F.col("own")).alias("fingerprint"),
        shown(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own_pieces"), F.col("other_pieces")).alias("near_edited"),
        likeness(F.col("own_pieces"), F.col("next_pieces")).alias("near_next"),
    )
