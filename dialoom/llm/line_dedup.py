"""Fuzzy line deduplication by block SimHash, by DataFrame functions alone.

1. Lines (text between line feeds) are normalised: lower case, runs of anything but letters and digits to one space. Lines without letters or digits stay and are compared with nothing. Equal normal forms are one
   line from here on, told apart by 128 bits of hash and counted before any join: a line of every document is one row.
2. A line's leading words come first when hashes are shifted right by the word's length, so that long, hence rare, words
   lead; a word that occurs twice leads twice. Its fingerprint has a block of 64 bits for each choice of some leading
   words: their SimHash, the bit by bit majority of the words' hashes. A word votes only in the blocks that hold it. A
   link changes at most a third of the longer line's words, d, and the first ``d + r`` words of two such lines have
   ``r`` in common (prefix filter), so they agree in all bits of a block of ``r`` words, however long the words are.
   Where the longer line has at most ``SHORT`` words, r is 3 (2 for three words) and d is taken in full: none is missed.
   Where it has more, r is 2 and d is taken as ``LEADING - 2`` at most: none is missed whose lines differ in at most that
   many words, which all links over words do up to ``5 * LEADING - 6`` words; of longer ones, see the README. The shorter
   line of a link needs no more leading words than its own length allows. Lines join on blocks.
3. A link is an edit similarity of ``similarity`` or more, over words; or over letters, where two thirds of the words agree
   in order. Lines are compared unless something rules a link out: the lengths, or the words that one line has and the
   other lacks, counted on ``64 * PARTS`` bits, which can't give too many. These travel with the blocks, so only pairs they leave open
   leave a block's task. A crowded block of lines unlike its first one is split by one more word; what stays crowded keeps
   all pairs. A line meets the first lines of its blocks, or pivots; then what lies in one block and in different components
   meets, pair by pair, in a crowded block after ``ROUNDS * PIVOTS`` more pivots. Only the texts of lines that something may be linked to, or that lie in crowded blocks, are read again.
4. Of each connected group the first occurrence is kept, by document id, then text hash, row and line number.

Null texts stay null; empty lines stay. A document all of whose lines are removed has an empty text. Repeated rows
count one after the other: the first one keeps its lines. Null ids come first. Columns of any other name are kept.
"""

from __future__ import annotations

import functools
import itertools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.llm.graph import components
from dialoom.llm.storage import Scratch, free_name, pinned

SIMILARITY, SHORT, LEADING, MAX_SHIFT = 0.8, 11, 8, 20
_LANES = 0x0000000100000001
#: 64-bit parts of a line's word bits; lines of at most ``WIDE`` words fill half of them, the others are 0.
PARTS, WIDE = 4, 64
#: The third vote of a block of two words.
_TIE = 0x5851F42D4C957F2D
#: Lines of a block whose pairs are all looked at; a block of more is crowded.
MANY = 64
#: Tables of blocks and of texts that are made one after the other, so that a part of them is shuffled at a time.
SLICES = 4
#: Further pivots of a crowded block that lies in several components.
ROUNDS, PIVOTS = 1, 16
_BITS = [f"s{i}" for i in range(PARTS)]
_FACTS = ["size", "chars", *_BITS]
#: One more than lead: it only splits crowded blocks.
_WORDS = [f"w{i}" for i in range(LEADING + 1)]
#: Third indices that stand for the third vote of a block of two words, of lines of three words at most and of others.
_TIES = (14, 15)
#: Bits of a word that splits a crowded block.
CODE = 9


#: Letters and digits; the first two classes are parts of the third and the fourth that are quicker to look up.
_KEPT = "\\p{L}\\p{Nd}\\p{IsAlphabetic}\\p{IsDigit}"


def normal_form(line: Column) -> Column:
    # a run that is one space stays as it is: most are, and replacing each takes longer than finding it
    return F.btrim(F.regexp_replace(F.lower(line), f"[^ {_KEPT}][^{_KEPT}]*| [^{_KEPT}]+", " "))


def _key(norm: Column) -> Column:
    return F.xxhash64(norm)


def _lines(rows: DataFrame, rid: str, text_col: str) -> DataFrame:
    """(rid, pos, norm) of the lines that have letters or digits."""
    lines = rows.select(rid, F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    return lines.select(rid, "pos", pinned(normal_form(F.col("line"))).alias("norm")).where("norm <> ''")


def ranked_words(norm: Column) -> Column:
    """Shifted hashes of the words, leading ones first."""
    ranked = F.transform(F.split(norm, " "), lambda w: F.call_function("shiftrightunsigned", F.xxhash64(w), F.least(F.length(w), F.lit(MAX_SHIFT))))
    return F.sort_array(ranked)


def _occurrences(top: Column) -> Column:
    """Later occurrences of a word count on from its hash."""
    return F.transform(top, lambda h, i: h + i - F.array_position(top, h) + 1)


def majority(a: Column, b: Column, c: Column) -> Column:
    """The SimHash of three hashes: each bit as most of them have it."""
    return a.bitwiseAND(b).bitwiseOR(a.bitwiseAND(c)).bitwiseOR(b.bitwiseAND(c))


def _combos(size: int) -> list[int]:
    """The choices of leading words that are blocks of a line of ``size`` words: three indices of four bits each."""
    d = min(size // 3, LEADING - 2)
    pairs = lambda n, tie: [(*x, tie) for x in itertools.combinations(range(n), 2)]
    out = pairs(size, _TIES[0]) if size <= 3 else []
    out += list(itertools.combinations(range(min(size, d + 3)), 3)) if size <= SHORT else []
    # the longer of two linked lines may have half as many words again
    out += pairs(d + 2, _TIES[1]) if 3 * size >= 2 * (SHORT + 1) else []
    return [i | j << 4 | k << 8 for i, j, k in out]


def _blocks(nodes: DataFrame) -> DataFrame:
    """(bucket, node, last, ext, facts): a row for each block of each line's fingerprint, with the index of its last word
    and ``CODE`` bits of each leading word that can come after it."""
    hashed = [F.when(F.col(x).isNotNull(), F.xxhash64(x)) for x in _WORDS]
    lines = nodes.where("w1 is not null").select(F.col("key").alias("node"), *_FACTS, F.array(*hashed).alias("w"))
    code = lambda i: F.call_function("shiftleft", F.coalesce(F.get("w", F.lit(i)).bitwiseAND(F.lit((1 << CODE) - 1)), F.lit(0).cast("long")), F.lit(CODE * (i - 2)))
    lines = lines.withColumn("ext", functools.reduce(Column.bitwiseOR, [code(i) for i in range(2, len(_WORDS))]))
    longest = 3 * (LEADING - 2)
    of_size = [F.array(*map(F.lit, _combos(n))).cast("array<int>") for n in range(2, longest + 1)]
    combos = functools.reduce(lambda out, n: out.when(F.col("size") == n, of_size[n - 2]), range(3, longest), F.when(F.col("size") == 2, of_size[0])).otherwise(of_size[-1])
    rows = lines.select("node", *_FACTS, "ext", "w", F.explode(combos).alias("c"))
    i, j, k = (F.shiftright("c", 4 * n).bitwiseAND(F.lit(15)) for n in range(3))
    third = F.when(k == _TIES[0], F.lit(~_TIE)).when(k == _TIES[1], F.lit(_TIE)).otherwise(F.get("w", k))
    return rows.select(majority(F.get("w", i), F.get("w", j), third).alias("bucket"), "node", F.when(k >= min(_TIES), j).otherwise(k).alias("last"), "ext", *_FACTS)


def _finer(large: DataFrame) -> DataFrame:
    """The blocks of one more word of crowded blocks: two lines whose first ``d + r`` words have ``r`` in common have
    ``r + 1`` in common in the first ``d + r + 1``, the last of which comes after the others in both. Lines of four words
    have no such word for sure, so they meet in a block of their own as well."""
    after = F.when(F.col("last") + 1 < F.least("size", F.lit(len(_WORDS))), F.sequence(F.col("last") + 1, F.least("size", F.lit(len(_WORDS))) - 1)).otherwise(F.array().cast("array<int>"))
    code = lambda i: F.call_function("shiftrightunsigned", F.col("ext"), CODE * (i - 2)).bitwiseAND(F.lit((1 << CODE) - 1)).cast("int")
    codes = F.concat(F.transform(after, code), F.when(F.col("size") <= 4, F.array(F.lit(-1))).otherwise(F.array().cast("array<int>")))
    rows = large.withColumn("code", F.explode(F.array_distinct(codes)))
    return rows.select(F.xxhash64("bucket", "code").alias("bucket"), "node", "last", "ext", *_FACTS)


def _meet(blocks: DataFrame, similarity: float) -> DataFrame:
    """(a, b, star): the pairs of a block that nothing known rules out, and whether ``a`` is the block's first line; or, where
    a is null, (bucket, n, node, last, ext, facts): a line of a crowded block. Nothing else of a block leaves its task."""
    by = W.partitionBy("bucket").orderBy("node")
    rows = blocks.withColumn("n", F.count("*").over(by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).where("n > 1")
    own = F.struct("node", *_FACTS)
    rows = rows.withColumn("before", F.collect_list(own).over(by.rowsBetween(1 - MANY, -1)))
    crowded = F.col("n") > MANY
    rows = rows.select("bucket", "n", "node", "last", "ext", *_FACTS, F.posexplode(F.when(crowded, F.array(own)).otherwise(F.col("before"))).alias("at", "x"))
    rows = rows.withColumns({f"x_{c}": F.col(f"x.{c}") for c in ["node", *_FACTS]}).where(crowded | ((F.col("x_node") < F.col("node")) & _near(similarity)))
    pair = [F.when(~crowded, c).alias(n) for n, c in (("a", F.col("x_node")), ("b", F.col("node")), ("star", F.col("at") == 0))]
    return rows.select(*pair, *(F.when(crowded, F.col(c)).alias(c) for c in ("bucket", "n", "node", "last", "ext", *_FACTS)))


def _bits(hashes: Column, parts: int) -> list[Column]:
    """``parts`` longs, with a bit for each word."""
    # looked up, as lambdas are interpreted: a step has half as many parts as one that shifts and compares
    signed = [1 << b if b < 63 else -(1 << 63) for b in range(64)]
    table = lambda i: F.array(*(F.lit(signed[b % 64] if b // 64 == i else 0).cast("long") for b in range(64 * parts)))
    part = lambda i: lambda got, h: got.bitwiseOR(F.get(table(i), h.bitwiseAND(F.lit(64 * parts - 1)).cast("int")))
    return [F.aggregate(hashes, F.lit(0).cast("long"), part(i)) for i in range(parts)]


def _sized_bits(hashes: Column, size: Column) -> list[Column]:
    """The bits of a line in ``PARTS`` longs, of which a line that isn't wide fills the first half. Folded, those of a wide one compare with it."""
    none, half = F.lit(0).cast("long"), PARTS // 2
    few = [*_bits(hashes, half), *[none] * half]
    return [F.when(size > WIDE, b).otherwise(f) for b, f in zip(_bits(hashes, PARTS), few, strict=True)]


def word_bits(held: DataFrame, parts: int = 4) -> DataFrame:
    """(node, chars, bits): ``parts`` longs, a power of two, with a bit for each word."""
    hashes = F.transform(F.split("norm", " "), lambda w: F.xxhash64(w))
    return held.select(F.col("key").alias("node"), F.length("norm").alias("chars"), *(b.alias(f"s{i}") for i, b in enumerate(_bits(hashes, parts))))


def simhashes(held: DataFrame) -> DataFrame:
    """(node, chars, sim): the 64-bit SimHash over all words. Sums per bit are in lanes of 32 bits, two to a long."""
    words = held.select("key", "norm", F.explode(F.split("norm", " ")).alias("word")).select("key", F.length("norm").alias("chars"), F.xxhash64("word").alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_LANES))).alias(f"s{i}") for i in range(32)]
    added = words.groupBy("key").agg(F.max("chars").alias("chars"), F.count("*").alias("n"), *sums)
    sim = F.lit(0).cast("long")
    for bit in range(64):
        lane = F.shiftrightunsigned(f"s{bit % 32}", bit - bit % 32).bitwiseAND(F.lit(0xFFFFFFFF))
        sim = sim.bitwiseOR(F.when(2 * lane > F.col("n"), F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
    return added.select(F.col("key").alias("node"), "chars", sim.alias("sim"))


def word_code(norm: Column) -> Column:
    """The line with each word as one of 49,152 code points, so that edits of words are edits of characters."""
    digits = F.transform(F.split(norm, " "), lambda w: F.hex(F.lit(0x1000) + F.pmod(F.xxhash64(w), F.lit(0xC000))))
    return F.decode(F.unhex(F.array_join(digits, "")), "UTF-16BE")


def _compared(pairs: DataFrame, held: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """(a, b) of the pairs (a, b) that are links: words decide from ``similarity`` on; pairs that are alike at two thirds
    of their words are compared letter by letter. Texts are only joined to the pairs that words leave open."""
    codes = held.select("key", "code", "chars")
    x = pairs.join(codes.toDF("b", "cb", "nb"), "b").join(codes.toDF("a", "ca", "na"), "a")
    longer = F.greatest(F.length("ca"), F.length("cb"))
    x = x.withColumn("words", pinned(F.expr("levenshtein(ca, cb, cast(floor(greatest(length(ca), length(cb)) / 3) as int))")))
    x = x.withColumn("most", F.floor((1 - similarity) * F.greatest("na", "nb") + 1e-9).cast("int"))
    near = F.col("words") >= 0
    few, most_agree = near & (F.col("words") <= (1 - similarity) * longer + 1e-9), near & (3 * F.col("words") <= longer)
    letters = F.abs(F.col("na") - F.col("nb")) <= F.col("most")
    looked = scratch.save(x.withColumn("few", few).where(F.col("few") | (most_agree & letters)).select("a", "b", "few", "most"), "looked")
    texts = held.select("key", "norm")
    left = looked.where("not few").join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a")
    left = left.where(pinned(F.expr("levenshtein(ta, tb, most) >= 0")))
    links = scratch.save(looked.where("few").select("a", "b").unionByName(left.select("a", "b")), "links")
    scratch.drop(looked)
    return links


def _met(nodes: DataFrame, scratch: Scratch, similarity: float) -> list[DataFrame]:
    """What meets in blocks, in ``SLICES`` tables, each of whole blocks: what is shuffled at once is a slice."""
    of_slice = lambda p: _blocks(nodes).where(F.pmod(F.xxhash64("bucket"), F.lit(SLICES)) == p)
    return [scratch.save(_meet(of_slice(p), similarity), "met") for p in range(SLICES)]


def _union(tables: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, tables)


def _crowded(met: list[DataFrame], scratch: Scratch, similarity: float) -> DataFrame | None:
    """(bucket, n, node, facts) of the crowded blocks that stay so: those most of whose lines are like the first one, and
    crowded finer blocks of the others, whose pairs are added to ``met``."""
    large = _union(met).where("a is null").drop("a", "b", "star")
    if not large.limit(1).count():
        return None
    first = F.min(F.struct("node", *_FACTS)).over(W.partitionBy("bucket"))
    rows = large.withColumn("x", first).withColumns({f"x_{c}": F.col(f"x.{c}") for c in _FACTS})
    rows = rows.withColumn("alike", F.sum(_near(similarity).cast("int")).over(W.partitionBy("bucket")))
    large = scratch.save(rows.select(*large.columns, (2 * F.col("alike") >= F.col("n")).alias("alike")), "crowded")
    met.append(scratch.save(_meet(_finer(large.where("not alike")), similarity), "met"))
    columns = ["bucket", "n", "node", *_FACTS]
    out = scratch.save(large.where("alike").select(columns).unionByName(met[-1].where("a is null").select(columns)), "crowded")
    scratch.drop(large)
    return out


def _pivots(large: DataFrame, similarity: float) -> DataFrame:
    """The crowded blocks' lines but the pivots, with ``pivot`` and whether nothing known rules a link to it out."""
    # the line that meets most others is the pivot: of near copies, the one closest to what they were made from
    met = large.groupBy("node").agg(F.sum("n").alias("met"))
    pivot = F.max(F.struct("met", "node", *_FACTS)).over(W.partitionBy("bucket"))
    x = large.join(met, "node").withColumn("x", pivot).where("node <> x.node").withColumns({f"x_{c}": F.col(f"x.{c}") for c in _FACTS})
    return x.select("bucket", "node", *_FACTS, F.col("x.node").alias("pivot"), _near(similarity).alias("near"))


def _groups(met: list[DataFrame], nodes: DataFrame, rows: DataFrame, rid: str, text_col: str, scratch: Scratch, similarity: float) -> DataFrame:
    """(node, component) of the lines that have links."""
    crowded, large = _crowded(met, scratch, similarity), None
    pairs = _union(met).where("a is not null")
    stars = pairs.where("star").select("a", "b")
    if crowded is not None:
        large = scratch.save(_pivots(crowded, similarity), "large")
        stars = stars.union(large.where("near").select(F.least("pivot", "node"), F.greatest("pivot", "node")))
        scratch.drop(crowded)
        at, large = large.scratch_path, large.drop("near")
        large.scratch_path = at
    stars = scratch.save(stars.distinct(), "stars")
    pairs = scratch.save(pairs.where("not star").select("a", "b").distinct(), "pairs")
    scratch.drop(*met)
    ends = [(stars, "a"), (stars, "b"), (pairs, "a"), (pairs, "b"), *([(large, "node")] if large is not None else [])]
    wanted = functools.reduce(DataFrame.union, [x.select(F.col(c).alias("key")) for x, c in ends])
    texts = _held(nodes.join(wanted.distinct(), "key", "left_semi"), rows, rid, text_col, scratch)
    held = _union(texts)
    links = _compared(stars, held, scratch, similarity)
    found = components(links, scratch)
    apart = _placed(pairs, found).where("ca <> cb").select("a", "b")
    found = _extended(found, _compared(apart, held, scratch, similarity), scratch)
    scratch.drop(stars, pairs)
    if large is not None:
        found = _crowded_groups(large, found, held, scratch, similarity)
    scratch.drop(*([large] if large is not None else []), *texts)
    return found


def _placed(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) with their components ``ca`` and ``cb``: a line that has no links is its own."""
    homes = [found.withColumnsRenamed({"node": x, "component": f"c{x}"}) for x in ("a", "b")]
    return pairs.join(homes[0], "a", "left").join(homes[1], "b", "left").withColumns({f"c{x}": F.coalesce(f"c{x}", x) for x in ("a", "b")})


def _extended(found: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The components of the links they were made of and of further ones, which only join components."""
    over = components(_placed(links, found).select(F.col("ca").alias("a"), F.col("cb").alias("b")), scratch)
    again = over.select(F.col("node").alias("component"), F.col("component").alias("new"))
    moved = found.join(again, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return scratch.save(moved.unionByName(over.join(found, "node", "left_anti")), "found")


def _held(nodes: DataFrame, rows: DataFrame, rid: str, text_col: str, scratch: Scratch) -> list[DataFrame]:
    """The texts of the lines of ``nodes``, in a table for each of ``SLICES`` ranges of rows, as whole documents are shuffled for them."""
    nodes = scratch.save(nodes.select("key", "rid", "pos"), "wanted")
    # a row's number begins with its partition's, in 31 bits over 33
    parts = (rows.agg(F.max(rid)).first()[0] or 0) // (1 << 33) + 1
    bounds = [(parts * p // SLICES) << 33 for p in range(SLICES + 1)]
    out = []
    for lo, hi in itertools.pairwise(bounds):
        if lo < hi:
            some = lambda x, c: x.where((F.col(c) >= F.lit(lo)) & (F.col(c) < F.lit(hi)))  # noqa: B023, E731
            out.append(scratch.save(_texts(some(nodes, "rid"), some(rows, rid), rid, text_col), "held"))
    scratch.drop(nodes)
    return out


def _texts(nodes: DataFrame, rows: DataFrame, rid: str, text_col: str) -> DataFrame:
    """(key, norm, code) of the lines of ``nodes``: no other line of their documents is normalised again."""
    wanted = nodes.groupBy(F.col("rid").alias("__at")).agg(F.collect_list(F.struct("key", "pos")).alias("__lines"))
    texts = rows.select(rid, text_col).join(wanted, F.col(rid) == F.col("__at")).select(F.split(text_col, "\n").alias("all"), "__lines")
    lines = texts.select(F.explode(F.transform("__lines", lambda x: F.struct(x["key"].alias("key"), F.get("all", x["pos"]).alias("line")))).alias("x"))
    lines = lines.select("x.key", pinned(normal_form(F.col("x.line"))).alias("norm"))
    return lines.select("key", "norm", F.length("norm").alias("chars"), pinned(word_code(F.col("norm"))).alias("code"))


def _crowded_groups(large: DataFrame, found: DataFrame, held: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """The components given, joined by the links of crowded blocks, whose pivots have met all of their lines."""
    placed = _torn(large, found, scratch)
    # lines of a crowded block are mostly joined by a few more pivots, picked by a hash; the rest meets one by one
    for seed in range(ROUNDS):
        picked = placed.groupBy("bucket").agg(F.array(*(F.min_by("node", F.xxhash64("node", F.lit(PIVOTS * seed + i))) for i in range(PIVOTS))).alias("picked"))
        picked = picked.select("bucket", F.explode(F.array_distinct("picked")).alias("node"))
        sides = _with_blocks(placed)
        more = _compared(_pairs(sides, sides.join(picked, ["bucket", "node"]), F.expr("component <> x_component"), similarity), held, scratch, similarity)
        found = _extended(found, more, scratch)
        before, placed = placed, _torn(placed.drop("component", "away"), found, scratch)
        scratch.drop(before, more)
    if not placed.limit(1).count():
        return found
    sides = _with_blocks(placed)
    across = _pairs(sides, sides.where("away"), F.expr("component <> x_component and (not away or node < x_node)"), similarity)
    across = scratch.save(across, "across")
    found = _extended(found, _compared(across, held, scratch, similarity), scratch)
    scratch.drop(across, placed)
    return found


def _with_blocks(placed: DataFrame) -> DataFrame:
    """The rows with all blocks of their lines: wide, so only joined where they are needed."""
    return placed.join(placed.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("blocks")), "node")


def _near(similarity: float) -> Column:
    """Whether nothing known of two lines, ``size`` and so on and ``x_size`` and so on, rules a link out."""
    longer = F.greatest("size", "x_size")
    # over words, or over letters
    alike = F.abs(F.col("size") - F.col("x_size")) <= (1 - similarity) * longer + 1e-9
    near = (F.abs(F.col("size") - F.col("x_size")) <= longer / 3) & (alike | (F.least("chars", "x_chars") >= similarity * F.greatest("chars", "x_chars") - 1))
    half = PARTS // 2
    wide = [[F.col(p + s) for s in _BITS] for p in ("", "x_")]
    folded = [[x.bitwiseOR(y) for x, y in zip(b[:half], b[half:], strict=True)] for b in wide]
    lacking = lambda one, other: functools.reduce(operator.add, [F.bit_count(x.bitwiseAND(F.bitwise_not(y))) for x, y in zip(one, other, strict=True)])
    for i in (0, 1):
        near = near & (F.when(F.least("size", "x_size") > WIDE, lacking(wide[i], wide[1 - i])).otherwise(lacking(folded[i], folded[1 - i])) <= longer / 3)
    return near


def _pairs(placed: DataFrame, some: DataFrame, which: Column, similarity: float) -> DataFrame:
    """(a, b): lines of one block of which ``which`` holds, where nothing known of them rules a link out."""
    near = _near(similarity)
    if "blocks" in placed.columns:  # lines that share several blocks meet in the least of them
        near = near & (F.array_min(F.array_intersect("blocks", "x_blocks")) == F.col("bucket"))
    pairs = placed.join(some.select("bucket", *(F.col(c).alias(f"x_{c}") for c in some.columns if c != "bucket")), "bucket").where(which & near)
    return pairs.select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b")).distinct()


def _torn(crowded: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of blocks that lie in several components, with ``component`` and whether that is another one than the pivot's."""
    homes = found.withColumnsRenamed({"node": "pivot", "component": "home"})
    placed = crowded.join(found, "node", "left").join(homes, "pivot", "left").withColumn("component", F.coalesce("component", "node"))
    placed = scratch.save(placed.withColumn("away", F.col("component") != F.coalesce("home", "pivot")).drop("home"), "homes")
    several = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
    torn = scratch.save(placed.join(several, "bucket", "left_semi"), "torn")
    scratch.drop(placed)
    return torn


def repeated_lines(rows: DataFrame, rid: str, scratch: Scratch, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, pos, grp, kept): a row for each line that has another one in its group. ``rid`` numbers the rows."""
    lines = _lines(rows, rid, text_col)
    lines = lines.withColumn("__ranked", pinned(F.when(F.instr("norm", " ") > 0, ranked_words(F.col("norm")))))
    lines = lines.withColumn("__top", pinned(_occurrences(F.slice("__ranked", 1, len(_WORDS)))))
    size = F.length("norm") - F.length(F.replace("norm", F.lit(" "))) + 1
    tops = [F.get("__top", F.lit(i)).alias(w) for i, w in enumerate(_WORDS)]
    lines = scratch.save(lines.select(F.col(rid).alias("rid"), "pos", _key(F.col("norm")).alias("key"), F.xxhash64(F.lit(1), "norm").alias("mark"), size.alias("size"), F.length("norm").alias("chars"), *(b.alias(x) for x, b in zip(_BITS, _sized_bits(F.col("__ranked"), size), strict=True)), *tops), "lines")
    # the mark is the second half of a line's identity: of lines with one key, links are those of the least mark
    nodes = lines.groupBy("key").agg(F.min("mark").alias("mark"), *(F.min_by(c, "mark").alias(c) for c in ("rid", "pos")), F.count("*").alias("n"), *(F.max(c).alias(c) for c in [*_FACTS, *_WORDS]))
    wide, nodes = lines, scratch.save(nodes, "nodes")
    lines = scratch.save(lines.select("rid", "pos", "key", "mark"), "lines")
    scratch.drop(wide)
    met, wide = _met(nodes, scratch, similarity), nodes
    nodes = scratch.save(nodes.drop(*_WORDS), "nodes")
    scratch.drop(wide)
    found = _groups(met, nodes, rows, rid, text_col, scratch, similarity)
    marked = nodes.select("key", "mark", "n").join(found, nodes.key == found.node, "left").where("n > 1 or component is not null")
    marked = scratch.save(marked.select("key", F.col("mark").alias("least"), "component"), "marked")
    scratch.drop(nodes)
    linked = F.col("component").isNotNull() & (F.col("mark") == F.col("least"))
    grp = F.when(linked, F.struct(F.col("component").alias("g"), F.lit(0).cast("long").alias("m"))).otherwise(F.struct(F.col("key").alias("g"), F.col("mark").alias("m")))
    placed = lines.select("rid", "pos", "key", "mark").join(marked, "key").select("rid", "pos", grp.alias("grp")).select("rid", "pos", "grp.g", "grp.m")
    named = rows.select(F.col(rid).alias("rid"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"))
    placed = scratch.save(placed.join(named, "rid"), "placed")
    scratch.drop(lines, marked)
    order = F.struct("id", "hash", "rid", "pos")
    first = placed.groupBy("g", "m").agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1")
    out = placed.join(first, ["g", "m"])
    return out.select("rid", "pos", F.struct("g", "m").alias("grp"), ((F.col("rid") == F.col("first.rid")) & (F.col("pos") == F.col("first.pos"))).alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with their own columns, less repeated lines; adds ``n_lines`` and ``removed`` (line numbers)."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    rid = free_name(docs, "__row")
    rows = scratch.save(docs.withColumn(rid, F.monotonically_increasing_id()), "rows")
    gone = repeated_lines(rows, rid, scratch, id_col=id_col, text_col=text_col, **options).where("not kept")
    gone = scratch.save(gone.groupBy(F.col("rid").alias("__gone")).agg(F.sort_array(F.collect_list("pos")).alias("removed")), "gone")
    out = rows.join(gone, F.col(rid) == F.col("__gone"), "left")
    lines = F.split(text_col, "\n")
    rest = F.array_join(F.array_compact(F.transform(lines, lambda x, i: F.when(~F.array_contains("removed", i), x))), "\n")
    return out.withColumns({
        "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
        text_col: F.when(F.col("removed").isNull(), F.col(text_col)).otherwise(rest),
        "removed": F.coalesce("removed", F.array().cast("array<int>")),
    }).drop(rid, "__gone")


def keep_lines(docs: DataFrame) -> DataFrame:
    """Documents with their own columns after line deduplication; those that lost all their words are left out."""
    inner = docs.select(F.col("doc_id"), F.col("text"), F.struct(*(c for c in docs.columns if c != "text")).alias("__doc"))
    out = dedup_lines(inner)
    lost = (F.size("removed") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    fields = [F.col("text") if c == "text" else F.length("text").cast("long").alias(c) if c == "n_chars" else F.col("__doc")[c].alias(c) for c in docs.columns]
    return out.where(~F.coalesce(lost, F.lit(False))).select(*fields)


def op3_line_dedup(docs: DataFrame) -> DataFrame:
    """Per document: its lines, the numbers of those removed, and the text that stays."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), "text")
