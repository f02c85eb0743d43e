"""Line dedup by an exact set-similarity join (operator 1); DataFrame functions only.

A line is the set of its words. Lines with equal sets are one class, kept at
its first occurrence. Between classes the join follows the prefix filter:

- words are ordered by rarity, counted over all lines in BUCKETS hash
  buckets (a table of fixed size, so it can go to every task whole);
- two sets of Jaccard t or more share a word within their first
  n - ceil(t n) + 1 words, of the shorter one within its first
  n - ceil(2t/(1+t) n) + 1;
- the length filter, the positional filter on the first shared word and a
  parity signature (sets differ in at least as many words as their
  signatures in bits) drop pairs that cannot reach t. The signature has 128
  bits, each word in one of them: two unrelated sets differ in about 64,
  while similar ones of n words differ in 0.22 n at most, so only lines of
  some 230 words or more pass by chance;
- the words of the few classes left are fetched and the Jaccard verified.

Where only the removal is wanted, not the number of links, a group of n nearly
equal lines is settled by n comparisons (``later_lines``). Where links are
counted, most of such a group's are told from the distances between its lines
and its centre (``judged_lines``).

Words are compared by their 64-bit hashes (55 bits where they make a class or
links are counted),
sets by 64 bits. Only the join of the prefix index with itself multiplies
rows, and AQE splits its hot keys.
"""

from __future__ import annotations

import gc
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelflow.session import staging_path

SIMILARITY = 0.8
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
HOT = 2                          # sets under a word from which its earliest one is tried first
MARK_BITS = 17                  # a bit set has 2**17 bytes; constants of a plan stay in the driver with its text

GROUP = 64                      # sets with a band in common from which they get a centre
BAND = 3                        # words of a band
_GAPS = "\t\x0B\f\r"            # white space inside a line, apart from spaces
_A_WORD = r"[^ \t\x0B\f\r]"


def _ceil(num: str, part: int, whole: int) -> str:
    """SQL of ceil(num * part / whole) in whole numbers."""
    return f"(({num}) * {part} + {whole - 1}) div {whole}"


def _words(line: Column) -> Column:
    """A line's words, repeats included."""
    return F.array_remove(_pieces(line, _GAPS), "")


def _pieces(text: Column, gaps: str) -> Column:
    """``text`` cut at every space and character of ``gaps``: no pattern, which takes twice the time."""
    for c in gaps:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.split(text, " ")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, same, line, t): one row per line of the documents that have a place."""
    return docs.where("doc_id is not null and text is not null").select("doc_id", "same", F.posexplode(F.split("text", "\n")).alias("line", "t"))


def _rarity(docs: DataFrame) -> Column:
    """An array constant: for each hash bucket a rarity class (0 rarest, below 128), from the words of all lines."""
    spark = docs.sparkSession
    words = docs.where("doc_id is not null and text is not null").select(F.explode(_pieces(F.col("text"), _GAPS + "\n")).alias("w"))
    counts = (words.select(F.expr(f"shiftrightunsigned(xxhash64(w), {64 - BUCKET_BITS})").alias("b"))
              .groupBy("b").agg(F.count("*").alias("n"))
              .union(spark.range(BUCKETS).select("id", F.lit(0).cast("long"))).groupBy("b").agg(F.sum("n").alias("n")))
    ranked = counts.select(F.struct("b", F.expr("least(125, cast(floor(4 * log2(n + 1)) as int))").alias("r")).alias("s"))
    text = ranked.agg(F.array_join(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["r"].cast("string")), ",")).first()[0]
    return F.split(F.lit(text), ",").cast("array<int>")         # folded to a constant when the plan is optimised


def _sets(lines: DataFrame, rarity: Column) -> DataFrame:
    """(doc_id, same, line, key, n, words): the different words of each line that has any, rarest first."""
    def code(w: Column) -> Column:
        h = F.xxhash64(w)
        # never null, so that arrays of plain longs are sorted
        return F.shiftleft(F.coalesce(F.get(rarity, F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int")), F.lit(0)).cast("long"), 55).bitwiseOR(F.shiftrightunsigned(h, 9))

    return (lines.where(F.regexp_like("t", F.lit(_A_WORD)))
            .select("doc_id", "same", "line", F.sort_array(F.array_distinct(F.transform(_words(F.col("t")), code))).alias("words"))
            .withColumn("n", F.size("words")).withColumn("key", F.xxhash64("words")))


def _marks(keys: DataFrame) -> bytes:
    """A bit set of MARK_BYTES bytes with the bit of every ``keys(h)`` set: of fixed size, so it can go to every task."""
    spark = keys.sparkSession
    bits = (keys.select(F.expr(f"shiftrightunsigned(h, {64 - MARK_BITS})").alias("b"), F.expr("cast(shiftleft(1, cast(h & 7 as int)) as int)").alias("v"))
            .groupBy("b").agg(F.bit_or("v").alias("v"))
            .union(spark.range(1 << MARK_BITS).select("id", F.lit(0))).groupBy("b").agg(F.bit_or("v").alias("v")))
    text = bits.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "v"))), lambda s: F.lpad(F.hex(s["v"]), 2, "0")), "")).first()[0]
    return bytes.fromhex(text)


def _marked(h: Column, marks: bytes) -> Column:
    """May ``h`` be among the marked keys? Never false for one that is."""
    byte = F.conv(F.hex(F.substr(F.lit(bytearray(marks)), (F.shiftrightunsigned(h, 64 - MARK_BITS) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, h.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Shuffle files stay on the executors' disks until the driver's garbage
    collector finds their plan gone; a stage's are not needed once it is
    written, so the collector is called here.
    """
    spark, path = df.sparkSession, staging_path(df.sparkSession, name)
    df.write.parquet(path)
    del df
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.parquet(path)


def _fraction(similarity: float) -> Fraction:
    t = Fraction(str(similarity))
    if not 0 < t <= 1:
        raise ValueError("similarity must be in (0, 1]")
    return t


def _parities() -> list[Column]:
    """Parities of the two halves of ``words``, told apart by bit 26 of a word, in 64 bits each."""
    return [F.expr(f"aggregate(words, 0L, (s, w) -> s ^ shiftleft(shiftrightunsigned({w}, 26) & 1L, cast(shiftrightunsigned(w, 20) & 63 as int)))") for w in ("w", "~w")]


def _prefix(t: Fraction) -> Column:
    return F.expr(f"transform(slice(words, 1, n - {_ceil('n', t.numerator, t.denominator)} + 1), w -> cast(w & 2147483647 as int))")


def _bands() -> Column:
    """Hashes of the BAND first, and last, of ``words`` in the order of their hashes: near copies mostly have one in common."""
    low = F.expr("sort_array(transform(words, w -> w & 36028797018963967L))")
    return F.transform(F.array(low), lambda w: F.array(F.xxhash64(F.slice(w, 1, BAND)), F.xxhash64(F.slice(w, -F.least(F.size(w), F.lit(BAND)), F.lit(BAND)))))[0]


def line_classes(docs: DataFrame, t: Fraction, banded: bool = False) -> DataFrame:
    """(key, doc_id, same, line, n, sig, sig2, prefix) of the different word sets, at their first places.

    The words stay in the texts: of the few sets that need them they are
    fetched from there. With ``banded`` the sets' bands come too.
    """
    sets = _sets(_lines(docs), _rarity(docs))
    parity, prefix, bands = _parities(), _prefix(t), [_bands().alias("bands")] if banded else []
    return (sets.select("key", F.struct("doc_id", "same", "line").alias("at"),
                        F.struct("n", *[p.alias(c) for p, c in zip(parity, ("sig", "sig2"))], prefix.alias("prefix"), *bands).alias("body"))
            .groupBy("key").agg(F.min("at").alias("at"), F.first("body").alias("body")).select("key", "at.*", "body.*"))


def _paired(t: Fraction) -> str:
    """SQL: can a set of n words have a different partner? Not if even n of n + 1 words fall short."""
    return f"n * {t.denominator} >= (n + 1) * {t.numerator}"


def _index(classes: DataFrame, t: Fraction, *more: str) -> DataFrame:
    """(key, sig, sig2, pos, word, n, *more): the prefixes of the sets that can have a different partner."""
    return classes.where(_paired(t)).select("key", "sig", "sig2", F.posexplode("prefix").alias("pos", "word"), "n", *more)


def _words_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """(key, at, words) of the classes ``wanted(key)``, from the texts at their first places."""
    places = _stored(classes.select("key", "doc_id", "same", "line").join(wanted, "key"), f"{name}-places")
    here = F.xxhash64("doc_id", "same", "line")
    marked = _lines(docs).where(_marked(here, _marks(places.select(here.alias("h")))))
    own = F.array_distinct(F.transform(_words(F.col("t")), lambda w: F.xxhash64(w)))
    return _stored(marked.join(places, ["doc_id", "same", "line"]).select("key", F.struct("doc_id", "same", "line").alias("at"), own.alias("words"))
                   .groupBy("key").agg(F.first("at").alias("at"), F.first("words").alias("words")), f"{name}-words")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, later) of the ``pairs(a, b, need)`` whose sets share ``need`` words or more, by the words themselves; later: a is after b."""
    words = _words_of(docs, classes, pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), "line")
    x, y = (words.select(F.col("key").alias(k), F.col("words").alias(f"w{k}"), F.col("at").alias(f"at_{k}")) for k in "ab")
    return _stored(pairs.join(x, "a").join(y, "b").where(F.size(F.array_intersect("wa", "wb")) >= F.col("need"))
                   .select("a", "b", (F.col("at_b") < F.col("at_a")).alias("later")), "line-links")


def _close(need: str) -> str:
    """SQL: may x and y share ``need`` words? Sets differ in at least as many words as their signatures in bits."""
    return f"bit_count(x.sig ^ y.sig) + bit_count(x.sig2 ^ y.sig2) <= x.n + y.n - 2 * ({need})"


def similar_lines(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Classes (key, doc_id, same, line) at their first places, and links (a, b), over ``docs(doc_id, same, text)``.

    Each pair of different classes whose Jaccard is ``similarity`` or more is one link.
    """
    t = _fraction(similarity)
    num, den = t.numerator, t.denominator
    need = _ceil("x.n + y.n", num, num + den)
    classes = _stored(line_classes(docs, t), "line-classes")
    index = _index(classes, t)
    x, y = index.alias("x"), index.alias("y")
    # both sides read one exchange: no condition is on one side alone
    pairs = _stored(x.join(y, F.expr(f"""x.word = y.word and (y.n < x.n or y.n = x.n and y.key < x.key)
                 and y.n * {den} >= x.n * {num}
                 and least(x.n - x.pos, y.n - y.pos) >= {need}
                 and {_close(need)}"""))
                    .selectExpr("x.key as a", "y.key as b", f"{need} as need").distinct(), "line-pairs")
    return classes.select("key", "doc_id", "same", "line"), _verified(docs, classes, pairs).select("a", "b")


def later_lines(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The same classes, and the keys (key) of those that match an earlier one, without listing all links.

    First every set is compared with the earliest set under each of its
    words that HOT sets or more share: of n copies of a line with small
    changes nearly all are settled here, by n comparisons instead of n^2.
    Only what is left is joined with the whole index, and only with earlier
    sets.
    """
    t = _fraction(similarity)
    num, den = t.numerator, t.denominator
    # keys that ascend with the first place, so that earlier is smaller
    ordered = line_classes(docs, t).orderBy("doc_id", "same", "line").withColumn("key", F.monotonically_increasing_id())
    classes = _stored(ordered, "line-classes")
    need = _ceil("x.n + y.n", num, num + den)
    close = f"y.n * {den} >= x.n * {num} and x.n * {den} >= y.n * {num} and y.key < x.key and {_close(need)}"
    out = ["x.key as a", "y.key as b", f"{need} as need"]
    index = _index(classes, t)
    first = (index.groupBy("word").agg(F.count("*").alias("c"), F.min("key").alias("key"), F.min_by("sig", "key").alias("sig"),
                                         F.min_by("sig2", "key").alias("sig2"), F.min_by("n", "key").alias("n"))
             .where(F.col("c") >= HOT))
    pairs = _stored(index.alias("x").join(first.alias("y"), F.expr("x.word = y.word and " + close)).selectExpr(*out).distinct(), "line-first-pairs")
    settled = _stored(_verified(docs, classes, pairs).select(F.col("a").alias("key")).distinct(), "line-settled")
    rest = _index(classes.join(settled, "key", "left_anti"), t)
    pairs = _stored(rest.alias("x").join(index.alias("y"), F.expr(f"x.word = y.word and {close} and least(x.n - x.pos, y.n - y.pos) >= {need}"))
                    .selectExpr(*out).distinct(), "line-pairs")
    later = settled.union(_verified(docs, classes, pairs).select("a").distinct())
    return classes.select("key", "doc_id", "same", "line"), later


def centred(docs: DataFrame, classes: DataFrame, t: Fraction) -> DataFrame:
    """(key, at, centre, d, slack) of the sets of groups of GROUP sets or more: the group's centre c and d = |x ^ c|.

    Groups are the sets with a band in common; a centre holds the words of
    more than half of a group, and groups of equal centres are one. Any set
    of words may serve as a centre: the difference |x ^ y| of two sets is at
    most |x ^ c| + |y ^ c|, so with slack = n (1 - t) - (1 + t) d, in whole
    numbers, x and y of one centre are similar if their slacks add up to 0 or
    more. A set of several groups goes to a centre that it is similar to, of
    these to the one that most sets are.
    """
    num, den = t.numerator, t.denominator
    banded = classes.where(_paired(t)).select("key", F.explode(F.array_distinct("bands")).alias("band"))
    large = banded.groupBy("band").agg(F.count("*").alias("c")).where(F.col("c") >= GROUP)
    wanted = _stored(banded.join(large, "band"), "line-groups")
    words = _words_of(docs, classes, wanted.select("key").distinct(), "line-group")
    members = _stored(words.withColumn("n", F.size("words")).join(wanted, "key"), "line-members")
    centres = (members.select("band", "c", F.explode("words").alias("w")).groupBy("band", "c", "w").agg(F.count("*").alias("held"))
               .where("2 * held > c").groupBy("band").agg(F.sort_array(F.collect_list("w")).alias("cw")))
    apart = F.expr("n + size(cw) - 2 * size(array_intersect(words, cw))")
    near = (members.join(centres, "band").select("key", "at", F.xxhash64("cw").alias("centre"), "n", F.size("cw").alias("nc"), apart.alias("d"))
            .groupBy("key", "centre").agg(F.min("at").alias("at"), F.min("n").alias("n"), F.min("nc").alias("nc"), F.min("d").alias("d")))
    near = _stored(near.withColumn("similar", F.expr(f"{den + num} * d <= (n + nc) * {den - num}")), "line-near")
    held = near.where("similar").groupBy("centre").agg(F.count("*").alias("c"))
    best = near.join(held, "centre").groupBy("key").agg(F.max(F.struct("similar", "c", "centre", "d", "n", "at")).alias("m"))
    return _stored(best.select("key", "m.at", "m.centre", "m.d", F.expr(f"{den - num} * m.n - {den + num} * m.d").alias("slack")), "line-centred")


def _sure(placed: DataFrame) -> DataFrame:
    """(key, links, later) by the pairs of one centre whose slacks add up to 0 or more: counted by slack, not listed."""
    by_slack = placed.groupBy("centre", "slack").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    asked = by_slack.select("centre", (-F.col("slack")).alias("v"), F.lit(1).alias("asks"), F.lit(0).cast("long").alias("c"), F.lit(None).cast(by_slack.schema["first"].dataType).alias("first"))
    down = Window.partitionBy("centre").orderBy(F.desc("v"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    sums = (by_slack.select("centre", F.col("slack").alias("v"), F.lit(0).alias("asks"), "c", "first").union(asked)
            .withColumn("total", F.sum("c").over(down)).withColumn("first", F.min("first").over(down))
            .where("asks = 1").select("centre", (-F.col("v")).alias("slack"), "total", "first"))
    own = F.when(F.col("slack") >= 0, 1).otherwise(0)
    return (placed.join(sums, ["centre", "slack"])
            .select("key", (F.col("total") - own).alias("links"), F.coalesce(F.col("first") < F.col("at"), F.lit(False)).alias("later")).where("links > 0"))


def judged_lines(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The classes of :func:`similar_lines`, and (key, links, later) of those that have a link.

    ``links`` counts a class's links, ``later`` tells whether one leads to an
    earlier class. Of a group of near copies only the pairs are listed and
    verified that their distances from the group's centre leave open: two
    sets differ in as many words as these add up to at most, and in as many as
    they are apart at least.
    """
    t = _fraction(similarity)
    num, den = t.numerator, t.denominator
    need = _ceil("x.n + y.n", num, num + den)
    classes = _stored(line_classes(docs, t, banded=True), "line-classes")
    placed = centred(docs, classes, t)
    marks = _marks(placed.select(F.col("key").alias("h")))
    plain = classes.select("key", "sig", "sig2", "n", "prefix")
    alone = plain.where(~_marked(F.col("key"), marks)).withColumns({"centre": F.lit(None).cast("long"), "d": F.lit(None).cast("int")})
    index = _index(alone.union(plain.where(_marked(F.col("key"), marks)).join(placed.select("key", "centre", "d"), "key", "left")), t, "centre", "d", "prefix")
    # near copies share most of their prefixes: a pair is left out where the words before are equal too, as it meets there
    index = index.withColumn("prev", F.get("prefix", F.col("pos") - 1)).drop("prefix")
    most = f"(x.n + y.n) * {den - num}"
    # both sides read one exchange: no condition is on one side alone
    pairs = _stored(index.alias("x").join(index.alias("y"), F.expr(f"""x.word = y.word and (y.n < x.n or y.n = x.n and y.key < x.key)
                 and y.n * {den} >= x.n * {num}
                 and least(x.n - x.pos, y.n - y.pos) >= {need}
                 and coalesce(x.prev <> y.prev, true)
                 and coalesce(x.centre <> y.centre or {den + num} * (x.d + y.d) > {most} and {den + num} * abs(x.d - y.d) <= {most}, true)
                 and {_close(need)}"""))
                    .selectExpr("x.key as a", "y.key as b", f"{need} as need").distinct(), "line-pairs")
    links = _verified(docs, classes, pairs)
    listed = links.select(F.col("a").alias("key"), F.lit(1).cast("long").alias("links"), "later").union(links.select("b", F.lit(1).cast("long"), ~F.col("later")))
    judged = listed.union(_sure(placed)).groupBy("key").agg(F.sum("links").alias("links"), F.max("later").alias("later"))
    return classes.select("key", "doc_id", "same", "line"), judged


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                links: bool = True) -> DataFrame:
    """(doc_id, same, n_lines, n_removed, n_links, text, rest): every row of ``docs`` once, without its later matches.

    A line goes if its words, as a set, have a Jaccard of ``similarity`` or
    more with those of a line that comes earlier: in a document of smaller
    id, or higher up in its own; lines are judged on the input, not on what
    is left. Lines without words stay and are not counted. ``n_links``
    counts the links to other classes of the lines that occur here first;
    with ``links=False`` it is null, and lines are settled by their first
    match instead of by all of them, which is the same text for less work.

    Null and empty texts come back as they are, with no lines. Rows that
    repeat an id are ordered by the hash (``same``) of their texts; equal
    rows are the same place, and all are treated alike. A row with a null id
    has no place in the order: it is left whole and removes nothing. A
    document that loses every line keeps its row. ``rest`` holds the other
    columns, whatever their names. Empty input gives no rows.
    """
    same = F.xxhash64(docs[text_col])
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), same.alias("same"), docs[text_col].alias("text"))
    rest = F.struct(*[docs[c] for c in docs.columns if c not in (id_col, text_col)] or [F.lit(None).cast("int").alias("none")])
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), same.alias("same"), docs[text_col].alias("text"), rest.alias("rest"))
    if links:
        classes, linked = judged_lines(slim, similarity)
    else:
        classes, later = later_lines(slim, similarity)
        linked = later.select("key", F.lit(None).cast("long").alias("links"), F.lit(True).alias("later"))
    kept = _stored(classes.join(linked, "key", "left").groupBy("doc_id", "same")
                   .agg(F.collect_list(F.when(~F.coalesce("later", F.lit(False)), F.col("line"))).alias("first"), F.sum("links").alias("links")), "line-kept")
    worded = F.filter(F.expr("sequence(0, size(all) - 1)"), lambda i: F.regexp_like(F.element_at("all", i + 1), F.lit(_A_WORD)))
    cut = rows.withColumn("all", F.split("text", "\n")).withColumn("worded", worded)
    # only documents that lose a line or hold a link meet their lists; the others are told apart by a bit set and pass
    counts = cut.where("doc_id is not null").select("doc_id", "same", F.size("worded").alias("n")).distinct()
    touched = counts.join(kept.select("doc_id", "same", F.size("first").alias("k"), "links"), ["doc_id", "same"], "left").where("n <> coalesce(k, 0) or links > 0")
    here = F.xxhash64("doc_id", "same")
    marks = _marks(touched.select(here.alias("h")))
    maybe = F.coalesce(F.col("doc_id").isNotNull() & _marked(here, marks), F.lit(False))
    none = F.lit(0).cast("long")
    lines = F.coalesce(F.size("worded"), F.lit(0)).cast("long").alias("n_lines")
    n_links = lambda c: (c if links else F.lit(None).cast("long")).alias("n_links")
    whole = cut.where(~maybe).select("doc_id", "same", lines, none.alias("n_removed"), n_links(none), "text", "rest")
    parts = (rows.where(maybe).join(kept, ["doc_id", "same"], "left").withColumn("all", F.split("text", "\n")).withColumn("worded", worded)
             .withColumn("gone", F.array_except("worded", F.coalesce("first", F.expr("cast(array() as array<int>)"))))
             .withColumn("stay", F.array_except(F.expr("sequence(0, size(all) - 1)"), "gone"))
             .select("doc_id", "same", lines, F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), n_links(F.coalesce("links", F.lit(0)).cast("long")),
                     F.when(F.size("gone") == 0, F.col("text")).otherwise(
                         F.array_join(F.transform("stay", lambda i: F.element_at("all", i + 1)), "\n")).alias("text"), "rest"))
    return whole.union(parts)


def drop_later_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs``, all rows and columns, with later matches gone from the text and ``chars_col``, if there, counted anew."""
    done = dedup_lines(docs, id_col, text_col, links=False)
    new = {id_col: F.col("doc_id").cast(docs.schema[id_col].dataType), text_col: F.col("text")}
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.col("n_removed") == 0, F.col("rest")[chars_col]).otherwise(F.length("text")).cast(docs.schema[chars_col].dataType)
    return done.select(*[new.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_links, kept_sha256."""
    return dedup_lines(docs, id_col, text_col).select("doc_id", "n_lines", "n_removed", "n_links", F.sha2("text", 256).alias("kept_sha256"))
