"""Line deduplication by deletion neighbourhoods, in DataFrame operations only.

Lines are compared by their lower-cased words. A line is dropped if an earlier one, in the order
(doc_id, line number), has the same words or, among lines of ``MIN_WORDS`` words and more, words
within one edit (a word replaced, inserted or deleted).

1. Equal lines meet by hash; the earliest stands for all of them.
2. Two lines within one edit agree in the first or in the second half of the shorter one. Lines
   that share such a half with no other line have no neighbour; the rest are candidates.
3. Candidates emit their deletion neighbourhood as hashed keys: the line without word i, tagged
   with i (equal keys: one word replaced), and the line itself and each line with one word left
   out (equal keys: one word inserted). Per key the earliest line and the earliest whole line
   are kept by aggregation, so a key shared by any number of lines yields one row per line and
   never all their pairs.
4. Each line is joined with the earliest ones of its keys, and the edit distance of the two is
   verified on their words.

Defined results: lines without words are kept; a null text stays null and an empty one empty; a
document that loses all lines with words has an empty result and ``n_kept`` 0; documents that
share doc_id and text are the same document and have the same result; a null doc_id comes last. The
work on a line grows in proportion to its words, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

MIN_WORDS = 8


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[ \t\u000B\f\r]+"), "")


def _half_keys(hashes: Column, n: Column) -> Column:
    """Hashes of the first and second half, for a partner as long as this line and for a shorter one."""

    def halves(m: Column) -> list[Column]:
        first = F.floor(m / 2).cast("int")
        rest = (m - first).cast("int")
        return [
            F.xxhash64(F.lit("first"), m, F.slice(hashes, F.lit(1), first)),
            F.xxhash64(F.lit("second"), m, F.slice(hashes, n - rest + 1, rest)),
        ]

    return F.array(*halves(n), *halves(n - 1))


def _identified(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Documents with ``rid``, which is equal for equal id and text."""
    return docs.withColumn("rid", F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")))


def lines_of(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(at, n, h, halves): one row per line with words; ``at`` orders lines and names them."""
    exploded = _identified(docs.select(key, text), text, key).select(
        F.col(f"`{key}`").alias("id"), "rid", F.posexplode(F.split(F.col(f"`{text}`"), "\n")).alias("no", "line")
    )
    # Told before the words are taken, which a filter on these would do a second time.
    worded = exploded.where(F.col("line").rlike(r"[^ \t\u000B\f\r]"))
    hashed = worded.withColumn("hashes", F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w)))
    # Null ids last: the flag is compared first.
    at = F.struct(F.col("id").isNull().alias("late"), "id", "rid", "no")
    n = F.size("hashes")
    halves = F.when(n >= MIN_WORDS, _half_keys(F.col("hashes"), n))
    return hashed.select(at.alias("at"), n.alias("n"), F.xxhash64(n, "hashes").alias("h"), halves.alias("halves"))


def _variants(candidates: DataFrame) -> DataFrame:
    """(key, whole, h, at): the deletion neighbourhood of each candidate.

    The hash of a word list is the xor of its words' hashes with their places, so what is left
    without a word follows from sums over the words before it, which keep their places, and those
    behind it, which move up by one: one row per word and one pass along the line.
    """
    zero = F.lit(0).cast("long")

    def summed(shift: int) -> Column:
        each = F.transform("words", lambda w, i: F.xxhash64(w, i - shift))
        return F.aggregate(each, zero, lambda done, x: done.bitwiseXOR(x))

    dealt = candidates.select(
        "h", "at", "uneven", "words", F.size("words").alias("n"), summed(0).alias("total"), summed(1).alias("last")
    ).repartition("h")  # before the rows become many
    each = dealt.select("h", "at", "uneven", "n", "total", "last", F.posexplode("words").alias("i", "word"))
    own, moved = F.xxhash64("word", "i"), F.xxhash64("word", F.col("i") - 1)
    along = Window.partitionBy("h").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    passed = each.withColumns({"own": own, "moved": moved}).withColumns(
        {"before": F.bit_xor("own").over(along).bitwiseXOR(F.col("own")), "until": F.bit_xor("moved").over(along)}
    )

    def variant(whole: bool, *parts: Column) -> Column:
        return F.struct(F.xxhash64(*parts).alias("key"), F.lit(whole).alias("whole"))

    left = F.col("before").bitwiseXOR(F.col("last")).bitwiseXOR(F.col("until"))
    swapped = variant(True, F.lit("swap"), F.col("n"), F.col("i"), F.col("total").bitwiseXOR(F.col("own")))
    shorter = variant(False, F.lit("drop"), F.col("n") - 1, left)
    itself = variant(True, F.lit("drop"), F.col("n"), F.col("total"))
    first = F.array(swapped, shorter, itself)
    every = F.when(~F.col("uneven"), F.array(swapped)).when(F.col("i") > 0, F.array(swapped, shorter)).otherwise(first)
    return passed.select("h", "at", F.explode(every).alias("v")).select("v.key", "v.whole", "h", "at")


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word lists differ by one replaced, inserted or deleted word at most."""

    def common(x: Column, y: Column) -> Column:
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
        return F.when(F.array_position(same, False) == 0, F.size(same)).otherwise(F.array_position(same, False) - 1)

    longest = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longest - 1)


def line_candidates(distinct: DataFrame) -> DataFrame:
    """(h, rid, no, at, uneven): distinct lines that share a half with another one."""
    halves = distinct.where(F.col("halves").isNotNull()).select("h", "n", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(
        F.min("h").alias("lo"), F.max("h").alias("hi"), (F.min("n") != F.max("n")).alias("uneven")
    )
    candidates = (
        halves.join(shared.where("lo != hi").select("half", "uneven"), "half")
        .groupBy("h")
        .agg(F.max("uneven").alias("uneven"))
    )
    places = distinct.select("h", F.col("at.rid").alias("rid"), F.col("at.no").alias("no"), "at")
    return places.join(candidates, "h")


def deduplicate_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with their text without dropped lines, and (n_lines, n_kept) as ``found``: (row, found).

    ``row`` holds all columns of ``docs`` with the new text; lines without words do not count.
    """
    lines = materialize(lines_of(docs, text, key), "lines")
    first = F.min(F.struct("at", "n", "halves")).alias("first")
    distinct = materialize(lines.groupBy("h").agg(first).select("h", "first.*"), "distinct-lines")
    candidates = line_candidates(distinct)
    worded = materialize(_with_words(docs, candidates, text, key), "candidate-words")
    variants = _variants(worded)
    best = variants.groupBy("key").agg(
        F.min(F.when(F.col("whole"), F.struct("at", "h"))).alias("whole_first"),
        F.min(F.struct("at", "h")).alias("any_first"),
        F.min("h").alias("lo"),
        F.max("h").alias("hi"),
    )
    best = best.where("lo != hi")
    # A whole line may repeat any line of its key, a shortened one only the whole line.
    earlier = F.when(F.col("whole"), F.col("any_first")).otherwise(F.col("whole_first"))
    pairs = (
        variants.join(best, "key")
        .select("h", "at", earlier.alias("e"))
        .where(F.col("e.at") < F.col("at"))
        .select("h", F.col("e.h").alias("earlier"))
        .distinct()
    )
    a = worded.select("h", F.col("words").alias("a"))
    b = worded.select(F.col("h").alias("earlier"), F.col("words").alias("b"))
    near = pairs.join(a, "h").join(b, "earlier").where(within_one_edit(F.col("a"), F.col("b"))).select("h").distinct()
    near = materialize(near.withColumn("near", F.lit(True)), "near-lines")

    judged = lines.select("h", "at").join(distinct.select("h", F.col("at").alias("first")).join(near, "h", "left"), "h")
    dropped = (
        judged.where(F.coalesce("near", F.lit(False)) | (F.col("at") != F.col("first")))
        .groupBy(F.col("at.rid").alias("rid"))
        .agg(F.collect_set("at.no").alias("dropped"))
    )
    kept_columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(
        kept_columns.alias("row"), F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("rid")
    )
    joined = packed.join(dropped, "rid", "left").withColumn("all", F.split(F.col(f"row.`{text}`"), "\n"))
    kept = F.when(F.col("dropped").isNull(), F.col("all")).otherwise(
        F.filter("all", lambda _, i: ~F.array_contains("dropped", i))
    )
    with_words = F.size(F.filter("all", lambda line: line.rlike(r"[^ \t\u000B\f\r]")))
    n_dropped = F.coalesce(F.size("dropped"), F.lit(0))
    new_text = F.when(F.col("dropped").isNull(), F.col(f"row.`{text}`")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col("all").isNull(), F.lit(0)).otherwise(with_words)
    return joined.select(
        F.col("row").withField(f"`{text}`", new_text).alias("row"),
        F.struct(
            n_lines.cast("long").alias("n_lines"), (n_lines - F.greatest(n_dropped, F.lit(0))).cast("long").alias("n_kept")
        ).alias("found"),
    )


def _with_words(docs: DataFrame, candidates: DataFrame, text: str, key: str) -> DataFrame:
    """Candidates with the words of their line, fetched from the document where it stands first."""
    wanted = candidates.groupBy("rid").agg(F.collect_list(F.struct("no", "h", "at", "uneven")).alias("wanted"))
    held = _identified(docs.select(key, text), text, key).select("rid", F.col(f"`{text}`").alias("text"))
    lines = held.join(wanted, "rid").select(F.split("text", "\n").alias("all"), F.explode("wanted").alias("w"))
    found = lines.select("w.h", "w.at", "w.uneven", words_of(F.get("all", F.col("w.no"))).alias("words"))
    return found.dropDuplicates(["h"])


def drop_repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents, with all their columns, without repeated lines; those left without words go.

    Documents that had no words to begin with stay.
    """
    found = deduplicate_lines(docs, text, key)
    return found.where((F.col("found.n_kept") > 0) | (F.col("found.n_lines") == 0)).select("row.*")
