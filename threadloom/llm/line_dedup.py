"""Line deduplication within an edit bound of one word, by a deletion-neighbourhood join in DataFrame operations.

Lines are \\n-split; words are runs of anything but ASCII white space, A-Z in lower case. Every line with a word is
compared. Two lines of at least NEAR_WORDS words are near when one word inserted, deleted or replaced makes them equal;
in shorter ones one word is a quarter or more of the line, and pairs that agree but for it do so by chance. A line is
repeated when an equal or near line stands earlier, by (id, line number). min_words is the least number of words of the
lines that are returned or removed; op2_line_dedup and the pipeline give 1, every line with a word.

1. Equal lines become one, kept by its earliest place.
2. A line of NEAR_WORDS words enters the neighbourhood join only if it shares its first or last half with another one: an edit leaves one
   of the halves as it is, so this loses nothing and keeps the variants of lines without partners out of the shuffle.
3. Each remaining line emits the hash of itself and of every variant with one word deleted. The hash of a word sequence
   is the xor of the hashes of (word, place), so all variants of a line come from running xors in one pass.
4. Lines are numbered in the order of their places. Equal variants with the deletion at the same place are a replacement; a variant equal to a whole line is an
   insertion. Only the earliest member of each group of equal variants is kept, by partial aggregation, so a group of
   any size makes no pairs.
5. The words of a line and of its earliest neighbour are compared; links of colliding hashes go.

Defined results: null and empty texts have no line and stay as they are; repeated rows (also of one id) are removed as
copies of the first, in no fixed order among rows of the same id; null ids come first; an empty table gives an empty
result; other columns are carried by `drop_repeated_lines` whatever their names, and not read by `judge_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.functions.binding import let
from threadloom.llm import common
from threadloom.llm.common import keys_hint, store

MIN_WORDS = 8
# Counted over sf0.1, pairs of different lines with one word replaced: 362 at 3 words, 35 at 4, 15 to 17 at 5, 6 and 7.
NEAR_WORDS = 5
# Bits of the map of text hashes that is copied to every executor: 16 MB, whatever the number of texts.
MAP_BITS = 2**27

_UPPER, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_words(line: Column) -> Column:
    return F.array_remove(F.split(F.translate(line, _UPPER, _LOW), r"[ \t\n\x0B\f\r]+"), "")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, line, words) of every line with a word; row tells repeated ids apart."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    lines = rows.select("id", "row", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    # Asked of the content: a filter on the words would be pushed below them with a second copy of the split.
    lines = lines.where(F.col("content").rlike(r"[^ \t\n\x0B\f\r]"))
    return lines.select("id", "row", "line", line_words(F.col("content")).alias("words"))


def _half_keys(words: Column, n: Column) -> Column:
    """Hashes of the halves a line shares with a near line of as many words or more, and of as many words or fewer."""

    def halves(shorter: Column) -> list[Column]:
        head = F.floor(shorter / 2).cast("int")
        return [
            F.xxhash64(shorter, F.lit("first"), F.slice(words, F.lit(1), head)),
            F.xxhash64(shorter, F.lit("last"), F.slice(words, n - (shorter - head) + 1, shorter - head)),
        ]

    return F.array(*halves(n), *halves(n - 1))


PLACE = ("id", "row", "line")


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in PLACE])


def _perhaps_in(docs: DataFrame, row: Column, keys: DataFrame) -> tuple[DataFrame, Column]:
    """docs joined with a bitmap of the hashes `_row` of keys, and whether a row's hash may be one of them.

    False is certain, true is not. So the texts that no key names need not be shuffled to be joined with the keys.
    """
    bit = lambda hashed: F.pmod(hashed, F.lit(MAP_BITS)) + 1
    of_keys = bit(F.col("_row"))
    bits = keys.groupBy(F.bitmap_bucket_number(of_keys).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(of_keys)).alias("_bits"))
    marked = docs.join(F.broadcast(bits), F.bitmap_bucket_number(bit(row)) == F.col("_bucket"), "left")
    place = F.bitmap_bit_position(bit(row)).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return marked, F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))


def judge_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, row, line, first_id, first_line, kept) of every line of at least min_words words.

    first_id and first_line name the earliest equal or near line, the line itself if there is none. row is the hash of
    the text, for ids that occur more than once.
    """
    return _judged(docs, id_col, text_col).where(F.col("n") >= min_words).drop("n")


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """What judge_lines gives, of every line with a word, and the number n of its words."""
    lines = _lines(docs, id_col, text_col).withColumn("n", F.size("words"))
    hashed = lines.select(
        *PLACE, F.col("n").cast("int").alias("n"), F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(2), "words").alias("h2"),
        F.when(F.col("n") >= NEAR_WORDS, _half_keys(F.col("words"), F.col("n"))).alias("keys"),
    )
    hashed = store(hashed, "line-hashes")
    # Equal lines have equal n and keys, so these may be grouped by as well; the buffers hold fixed-width values only.
    keys = [F.col("keys")[i].alias(f"k{i}") for i in range(4)]
    ranked = hashed.select(*PLACE, "n", "h1", "h2", *keys)
    firsts = ranked.groupBy("h1", "h2", "n", "k0", "k1", "k2", "k3").agg(F.min(_place()).alias("first"))
    keys = F.when(F.col("n") >= NEAR_WORDS, F.array("k0", "k1", "k2", "k3"))
    firsts = store(firsts.select("h1", "h2", "n", keys.alias("keys"), "first"), "first-lines")

    # Numbers in the order of places stand for them from here on: one long instead of three columns in every variant.
    candidates = _sharing_a_half(firsts).orderBy(*PLACE).withColumn("no", F.monotonically_increasing_id())
    candidates = store(candidates, "half-partners")
    total = candidates.count()
    # Only documents with candidates are read again, and only their candidate lines leave the scan.
    known = candidates.select(F.col("id").alias("_id"), F.col("row").alias("_row")).distinct()
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    if total > common.BROADCAST_KEYS:
        marked, perhaps = _perhaps_in(source, source["row"], known)
        source = marked.where(perhaps).select("id", "row", "text")
    hint = keys_hint(known, total)
    source = source.join(hint, source["id"].eqNullSafe(F.col("_id")) & (source["row"] == F.col("_row")), "left_semi")
    words = _lines(source.select(F.col("id"), "text"), "id", "text")
    picked = candidates.select("no", *[F.col(c).alias("_" + c) for c in PLACE])
    same = words["id"].eqNullSafe(F.col("_id")) & (words["row"] == F.col("_row")) & (words["line"] == F.col("_line"))
    words = words.join(keys_hint(picked, total), same).select("no", "words").dropDuplicates(["no"])
    words = store(words, "candidate-lines")

    near = store(_earliest_near(words), "near-lines")
    named = candidates.select("no", *[F.col(c).alias("_" + c) for c in PLACE])
    earlier = candidates.select(F.col("no").alias("earliest"), _place().alias("place"))
    near = near.join(named, "no").join(earlier, "earliest").select(*["_" + c for c in PLACE], "place")
    firsts = firsts.select("h1", "h2", "first", *[F.col("first")[c].alias(c) for c in PLACE])
    same = firsts["id"].eqNullSafe(F.col("_id")) & (firsts["row"] == F.col("_row")) & (firsts["line"] == F.col("_line"))
    firsts = firsts.join(near, same, "left").select("h1", "h2", F.least("first", F.coalesce("place", "first")).alias("first"))
    judged = hashed.select(*PLACE, "n", "h1", "h2").join(firsts, ["h1", "h2"])
    return judged.select(
        *PLACE, "n", F.col("first.id").alias("first_id"), F.col("first.line").alias("first_line"), (F.col("first") == _place()).alias("kept")
    )


def _sharing_a_half(firsts: DataFrame) -> DataFrame:
    """Places of lines that share a half with another one."""
    keys = firsts.select("first", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = keys.join(shared, "key", "left_semi").select(*[F.col("first")[c].alias(c) for c in PLACE])
    return found.distinct()


def _earliest_near(words: DataFrame) -> DataFrame:
    """(no, earliest): the number of the earliest near line of each line that has an earlier one."""
    # Lines are dealt before they are taken apart, so that words, not rows of hashes, are what is shuffled.
    dealt = words.repartition("no")
    placed = dealt.select("no", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    placed = placed.select("no", "n", "i", F.xxhash64("i", "word").alias("here"), F.xxhash64(F.col("i") - 1, "word").alias("moved"))
    line = Window.partitionBy("no")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    xored = placed.select(
        "no", "n", "i", "here", "moved",
        F.expr("bit_xor(here)").over(upto).alias("head"), F.expr("bit_xor(moved)").over(upto).alias("tail"),
        F.expr("bit_xor(moved)").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_moved"),
    )
    # Without word i: the words before it as they stand, those after it one place further left.
    variant = F.col("head").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("all_moved")).bitwiseXOR(F.col("tail"))
    xored = xored.select("no", "n", "i", variant.alias("variant"), "head")

    members = xored.select(F.xxhash64("n", "i", "variant").alias("key"), "no")
    replaced = members.groupBy("key").agg(F.min("no").alias("earliest"), F.max("no").alias("latest"))
    replaced = replaced.where("earliest < latest").select("key", "earliest")
    by_replacement = members.join(replaced, "key").select("no", "earliest")

    shorter = xored.select(F.xxhash64(F.col("n") - 1, "variant").alias("key"), "no")
    whole = xored.where(F.col("i") == F.col("n") - 1).select(F.xxhash64("n", "head").alias("key"), F.col("no").alias("whole"))
    inserted = shorter.join(whole, "key").select("no", "whole")
    longer = inserted.groupBy(F.col("whole").alias("no")).agg(F.min("no").alias("earliest"))
    links = by_replacement.unionByName(inserted.select("no", F.col("whole").alias("earliest"))).unionByName(longer)
    links = links.where(F.col("earliest") < F.col("no")).distinct()

    own = words.select("no", F.col("words").alias("own"))
    other = words.select(F.col("no").alias("earliest"), F.col("words").alias("other"))
    checked = links.join(own, "no").join(other, "earliest").where(one_word_apart(F.col("own"), F.col("other")))
    return checked.groupBy("no").agg(F.min("earliest").alias("earliest"))


def one_word_apart(a: Column, b: Column) -> Column:
    """Word edit distance of at most one: common head and common tail leave at most one word on either side."""

    def ordered(pair: Column) -> Column:
        short, long = pair["short"], pair["long"]
        n, m = F.size(short), F.size(long)
        head = F.zip_with(short, F.slice(long, F.lit(1), n), lambda x, y: x == y)
        first = F.array_position(head, False).cast("int")  # 1-based place of the first difference, 0 if there is none
        rest = F.slice(short, first + F.when(n == m, 1).otherwise(0), n) == F.slice(long, first + 1, m)
        return (m - n <= 1) & F.when(first == 0, True).otherwise(rest)

    shorter = F.size(a) <= F.size(b)
    pair = F.struct(F.when(shorter, a).otherwise(b).alias("short"), F.when(shorter, b).otherwise(a).alias("long"))
    return let(pair, ordered)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs without the lines that judge_lines does not keep, all columns as they are.

    A document of which lines were removed and every line with a word is repeated goes too, those of fewer than
    min_words words included; one line of any length that is not repeated keeps it.
    """
    judged = _judged(docs, id_col, text_col)
    removed = judged.groupBy(F.col("id").alias("_id"), F.col("row").alias("_row")).agg(
        F.collect_set(F.when(~F.col("kept") & (F.col("n") >= min_words), F.col("line"))).alias("_removed"), F.max(F.col("kept").cast("int")).alias("_left")
    )
    removed = store(removed.where(F.size("_removed") > 0), "removed-lines")
    total = removed.agg(F.coalesce(F.sum(F.size("_removed") + 4), F.lit(0))).first()[0]
    as_they_are = None
    if total > common.BROADCAST_KEYS:
        marked, perhaps = _perhaps_in(docs, F.xxhash64(text_col), removed)
        as_they_are = marked.where(~perhaps).select(*[docs[c] for c in docs.columns])
        docs = marked.where(perhaps).select(*[docs[c] for c in docs.columns])
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(text_col) == F.col("_row"))
    joined = docs.join(keys_hint(removed, total), same, "left").where(F.col("_removed").isNull() | (F.col("_left") == 1))

    def without(lines: Column, numbers: Column) -> Column:
        """The stretches of lines between removed ones."""
        bounds = F.concat(F.array(F.lit(-1)), F.array_sort(numbers), F.array(F.size(lines)))
        stretch = lambda b: F.transform(F.sequence(F.lit(0), F.size(b) - 2), lambda j: F.slice(lines, b[j] + 2, b[j + 1] - b[j] - 1))
        return F.array_join(F.flatten(let(bounds, stretch)), "\n")

    def left(numbers: Column) -> Column:
        return let(F.split(text_col, "\n"), lambda lines: without(lines, numbers))

    text = F.when(F.col("_removed").isNull(), F.col(text_col)).otherwise(left(F.col("_removed")))
    left_over = joined.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])
    return left_over if as_they_are is None else left_over.union(as_they_are)
