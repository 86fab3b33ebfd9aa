"""Fuzzy line deduplication in DataFrame expressions only.

1. Lines are lower-cased and reduced to words of letters and digits. In lines that take two bytes of UTF-8 or more a character, each
   character of a script written without spaces is a word of its own. Lines of fewer than ``min_words`` words are never dropped.
2. Equal normalised lines become one (told apart by two 64-bit hashes), represented by their first occurrence.
3. Each gets a SimHash of its words of 60 bits, in which every word that begins with a digit counts as 0. The bits are laid out in
   BLOCKS blocks, and a word votes on the bits of one block only, chosen by its hash. So a word that is replaced touches two blocks at
   most, one that is added or left out one, and a number replaced by another none; the other blocks keep their bits and their numbers
   of words.
4. Lines are candidates if two blocks (TAKEN of BLOCKS, by the pigeonhole principle enough for any one word) agree in bits and number
   of words, hold ``least_shared`` words or more and a quarter of each line's, and if the whole SimHashes differ in ``budget`` bits at
   most. Each pair of blocks is a key. The lines of a key are first compared with its head, the one of least hash, and those linked
   form groups; then only the pairs of different groups are left. So the n * n pairs of a line's n variants are never made. Pairs are
   left out whose words, counted modulo 16 in BAGS bags by their hashes, differ more than the edits allowed can explain (two for each
   edit): an exact test that loses no link.
5. A pair is linked if the edit similarity of its normalised lines, counted in words (each as one code point of its hash, of 2**19),
   is at least ``similarity``. All lines are compared alike, whatever their length.
6. Of each connected group the first occurrence stays: the least (id, hash of text, line number).

Only lines in candidate pairs have their texts read again and compared. Places are broadcast where they are counted to be few
(``small``), otherwise joined by a shuffle, in which adaptive execution splits hot keys.

A pair is named by the lines' first hash; lines that shared it by accident would be compared too, each by its own text.

Rows: null text counts as empty and has one empty line; a null id sorts first; rows with equal id and text are one document and
share its decisions; ties go by the order above. Ids may be of any orderable type. An empty table gives no rows. Columns other than
id and text are ignored (report) or passed on whatever their names (deduplicated).
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.components import components
from txnlake.llm.store import fresh, release, written

LANES = 0x0101010101010101
BLOCKS, TAKEN = 5, 2
WIDTH = 12  # bits of a block, and of its number of words
FULL = (1 << WIDTH) - 1
STRIDE = 4
CHUNK = 120  # a multiple of STRIDE, and no more than fits a signed byte
BAGS = 16
SEPARATORS = r"[^\p{L}\p{N}]+"
SPACELESS = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def _spaced(low: Column) -> Column:
    return F.when(F.octet_length(low) >= 2 * F.length(low), F.regexp_replace(low, SPACELESS, " $1 ")).otherwise(low)


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(_spaced(F.lower(line)), SEPARATORS, " "))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, t, text): d and t tell documents apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))


def _count(block: int) -> str:
    return f"(shiftrightunsigned(m, {WIDTH * block}) & {FULL})"


BAG_COLUMNS = [f"c{i}" for i in range(BAGS // 8)]


def _bag(column: str, at: int) -> str:
    return f"(shiftrightunsigned({column}, {8 * at}) & 255L)"


def _johnson(c: str) -> str:
    """SQL that turns eight byte-wide counts into Johnson codes of the counts modulo 16.

    Two codes of eight bits differ in as many bits as the counts do modulo 16, at most what the counts differ by. A code is the lowest
    r bits, r the count modulo 8, all turned round if the count has the bit of 8.
    """
    b0, b1, b2, b3 = c, *[f"shiftrightunsigned({c}, {i})" for i in (1, 2, 3)]
    more = [f"{b0} | {b1} | {b2}", f"{b1} | {b2}", f"{b2} | ({b1} & {b0})", b2, f"{b2} & ({b0} | {b1})", f"{b2} & {b1}", f"{b2} & {b1} & {b0}"]
    low = " | ".join(f"shiftleft(({x}) & {LANES}L, {i})" for i, x in enumerate(more))
    return f"({low}) ^ (shiftleft({b3} & {LANES}L, 8) - ({b3} & {LANES}L))"


def _bags_apart(a: str, b: str) -> str:
    """SQL for what two lines' bags, as Johnson codes, differ by at least; short, as methods of more than 8000 bytes are never compiled."""
    return " + ".join(f"bit_count({a}{c} ^ {b}{c})" for c in BAG_COLUMNS)


def _majority() -> str:
    """SQL for the fingerprint from the counters l0 to l7 and m.

    Byte j of counter k is bit k + 8 * j. In 16-bit lanes, a counter exceeds half of m exactly if adding 127 - m div 2 sets bit 7.
    """

    def half(k: int, by: int) -> str:
        adds = []
        for i in range(BLOCKS):
            lanes = sum(1 << 16 * j for j in range(4) if (k + 16 * j + by) // WIDTH == i)
            if lanes:
                adds.append(f"(127 - {_count(i)} div 2) * {lanes}L")
        votes = f"(shiftrightunsigned(l{k}, {by}) & {0x00FF00FF00FF00FF}L)"
        return f"shiftrightunsigned(({' + '.join([votes, *adds])}) & {0x0080008000800080}L, 7)"

    return " | ".join(f"shiftleft({half(k, 0)} | shiftleft({half(k, 8)}, 8), {k})" for k in range(8))


def simhashes(texts: DataFrame, min_words: int) -> DataFrame:
    """(d, t, line, words, h1, h2, fp, m) of the lines of (d, t, text) with min_words words or more.

    h1 and h2 are two 64-bit hashes of the sequence of words, fp is its SimHash and m has the numbers of words in its blocks, WIDTH bits
    each and FULL at most. Words are summed STRIDE to a row, then in eight longs of eight byte-wide counters, the k-th of the bits k,
    k + 8, ..., for up to CHUNK words of a line at a time; the sums are complete before the shuffle, as a line's words are in one task.
    Words that begin with a digit vote as 0.
    """
    keys = ["d", "t", "row", "line"]
    w = texts.select("d", "t", F.monotonically_increasing_id().alias("row"), "text").select("d", "t", "row", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    # as a generator's output the words are split once, however often they are looked at
    w = w.select(*keys, F.lower("raw").alias("low")).select(*keys, F.explode(F.array(F.split(_spaced(F.col("low")), SEPARATORS))).alias("all"))
    # separators at the ends leave an empty string there
    lead = F.when(F.get("all", F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size("all") > 1) & (F.element_at("all", -1) == ""), 1).otherwise(0)
    w = w.select(*keys, lead.alias("lead"), (F.size("all") - lead - tail).alias("words"), "all").where(F.col("words") >= min_words)
    w = w.select(*keys, "words", F.expr("if(words = size(all), all, slice(all, lead + 1, words))").alias("all"))
    w = w.select(*keys, "words", "all", F.xxhash64("all").alias("h1"), F.xxhash64(F.lit(1), "all").alias("h2"))
    # STRIDE words to a row, those beyond the last masked; each step is a projection of its own, so that nothing is worked out twice
    each, line = range(STRIDE), ["words", "h1", "h2"]
    w = w.select(*keys, *line, "all", F.explode(F.expr(f"sequence(0, words - 1, {STRIDE})")).alias("at"))
    here = [F.expr(f"if(at + {j} < words, -1L, 0L)").alias(f"k{j}") for j in each]
    w = w.select(*keys, *line, F.expr(f"at div {CHUNK}").alias("chunk"), *here, *[F.expr(f"coalesce(get(all, at + {j}), '')").alias(f"w{j}") for j in each])
    line += ["chunk", *[f"k{j}" for j in each]]
    w = w.select(*keys, *line, *[F.xxhash64(f"w{j}").alias(f"o{j}") for j in each], *[F.expr(f"w{j} < ':'").alias(f"n{j}") for j in each])
    bag = [F.expr(f"shiftleft(k{j} & 1L, cast(shiftleft(o{j} & 7L, 3) as int))").alias(f"g{j}") for j in each]
    w = w.select(*keys, *line, *[f"o{j}" for j in each], *bag, *[F.expr(f"if(n{j}, xxhash64('0'), o{j})").alias(f"x{j}") for j in each])
    bags = [" + ".join(f"if((o{j} & {BAGS - 8}L) = {8 * i}L, g{j}, 0L)" for j in each) for i in range(BAGS // 8)]
    block = [F.expr(f"{WIDTH} * cast(shiftrightunsigned(shiftrightunsigned(x{j}, 48) * {BLOCKS}, 16) as int)").alias(f"b{j}") for j in each]
    w = w.select(*keys, *line, *[F.expr(x).alias(c) for c, x in zip(BAG_COLUMNS, bags, strict=True)], *[f"x{j}" for j in each], *block)
    line = ["words", "h1", "h2", "chunk", *BAG_COLUMNS]
    one = " + ".join(f"shiftleft(k{j} & 1L, b{j})" for j in each)
    w = w.select(*keys, *line, F.expr(one).alias("m"), *[F.expr(f"k{j} & x{j} & shiftleft({FULL}L, b{j})").alias(f"v{j}") for j in each])
    lanes = [F.expr(" + ".join(f"(shiftrightunsigned(v{j}, {k}) & {LANES}L)" for j in each)).alias(f"l{k}") for k in range(8)]
    w = w.select(*keys, *line, "m", *lanes)
    # the number of words is no grouping key, so that the two filters below stay above the sums and share them
    w = w.groupBy(*keys, "chunk").agg(*[F.max(c).alias(c) for c in ("words", "h1", "h2")], *[F.sum(c).alias(c) for c in ("m", *BAG_COLUMNS, *[f"l{k}" for k in range(8)])])
    own = ["d", "t", "line", "words", "h1", "h2", *BAG_COLUMNS, "fp", "m"]
    short = w.where(F.col("words") <= CHUNK).withColumn("fp", F.expr(_majority())).select(*own)
    # longer lines: one row for each chunk, whose counters are summed by two in a long, 32 bits each
    apart = lambda c, p: F.sum(F.expr(f"shiftrightunsigned({c}, {8 * p}) & {0x000000FF000000FF}L"))
    votes = [apart(f"l{k}", p).alias(f"l{k}_{p}") for k in range(8) for p in range(4)]
    totals = [F.sum(F.expr(_count(i))).alias(f"m{i}") for i in range(BLOCKS)]
    totals += [apart(c, p).alias(f"{c}_{p}") for c in BAG_COLUMNS for p in range(4)]
    long = w.where(F.col("words") > CHUNK).groupBy(*keys).agg(F.max("words").alias("words"), F.max("h1").alias("h1"), F.max("h2").alias("h2"), *totals, *votes)
    # a counter exceeds half of m exactly if adding 2**30 - 1 - m div 2 sets bit 30
    long = long.withColumns({f"q{i}": F.expr(f"{(1 << 30) - 1} - m{i} div 2") for i in range(BLOCKS)})
    more = lambda bit: f"q{bit // WIDTH}" if bit < BLOCKS * WIDTH else "0L"
    half = lambda at: f"shiftrightunsigned(l{at % 8}_{at // 8} + {more(at)} + shiftleft({more(at + 32)}, 32), 30) & {0x100000001}L"
    bits = " | ".join(f"shiftleft({half(at)}, {at})" for at in range(32))
    m = " | ".join(f"shiftleft(least(m{i}, {FULL}L), {WIDTH * i})" for i in range(BLOCKS))
    bags = [F.expr(" | ".join(f"shiftleft({c}_{p} & {0x000000FF000000FF}L, {8 * p})" for p in range(4))).alias(c) for c in BAG_COLUMNS]
    return short.unionByName(long.select(*own[:6], *bags, F.expr(bits).alias("fp"), F.expr(m).alias("m")))


def keyed(lines: DataFrame, least_shared: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(key, h1, *extra): a row for each line (h1, words, fp, m) and pair of blocks that holds enough of its words."""
    need = F.expr(f"greatest({least_shared}, (least(words, {FULL}) + 3) div 4)").alias("need")
    lines = lines.select("h1", "fp", "m", need, *[F.expr(_count(i)).alias(f"n{i}") for i in range(BLOCKS)], *[c for c in extra if c != "fp"])
    parts = []
    for n, c in enumerate(itertools.combinations(range(BLOCKS), TAKEN)):
        bits, held = sum(FULL << WIDTH * i for i in c), " + ".join(f"n{i}" for i in c)
        parts.append(F.expr(f"if({held} >= need, xxhash64({n}, fp & {bits}L, m & {bits}L), null)"))
    return lines.select(F.explode(F.array(*parts)).alias("key"), "h1", *extra).where("key IS NOT NULL")


def _symbols(norm: str) -> str:
    """SQL for a string with one code point for each word."""
    return f"decode(unhex(array_join(transform(split({norm}, ' '), w -> concat('000', hex(pmod(xxhash64(w), 524288) + 65536))), '')), 'UTF-32')"


def _small(df: DataFrame, small: int) -> DataFrame:
    """A table to be broadcast if it is counted to be of small rows at most; otherwise joined by a shuffle."""
    return F.broadcast(df) if df.limit(small + 1).count() <= small else df


def _placed(known: DataFrame, firsts: DataFrame) -> DataFrame:
    """known with the place of each line's first occurrence."""
    return known.join(firsts, ["h1", "h2"], "left").withColumn("first", F.coalesce("first", F.struct("d", "t", "line")))


def verified(pairs: DataFrame, texts: DataFrame, known: DataFrame, firsts: DataFrame, similarity: float, small: int) -> DataFrame:
    """The pairs whose lines are similar; each line's text is read where it occurs first."""
    members = written(pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct(), "pair_lines")
    place = _placed(known.join(_small(members, small), "h1", "left_semi"), firsts).select("h1", "first.*")
    wanted = written(place.groupBy("d", "t").agg(F.collect_list(F.struct("line", "h1")).alias("wanted")), "members")
    wanted = _small(wanted.withColumnsRenamed({"d": "of", "t": "key"}), small // 4)
    found = texts.join(wanted, (F.col("t") == F.col("key")) & F.col("d").eqNullSafe(F.col("of")))
    found = found.select("wanted", F.split("text", "\n").alias("lines"))
    raw = F.explode(F.transform("wanted", lambda x: F.struct(x["h1"].alias("h1"), F.get("lines", x["line"]).alias("raw")))).alias("x")
    found = found.select(raw).select("x.h1", normalised(F.col("x.raw")).alias("norm"))
    found = written(found.select("h1", F.expr(_symbols("norm")).alias("s")), "member_texts")
    both = pairs.join(found.select(F.col("h1").alias("a"), F.col("s").alias("sa")), "a").join(found.select(F.col("h1").alias("b"), F.col("s").alias("sb")), "b")
    edits = f"cast(floor({1 - similarity:.6f} * greatest(length(sa), length(sb)) + 1e-9) as int)"
    out = written(both.where(f"levenshtein(sa, sb, {edits}) >= 0").select("a", "b"), "linked")
    release(found)
    return out


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5, least_shared: int = 3, budget: int = 14, similarity: float = 0.8, small: int = 1_000_000) -> DataFrame:
    """(d, t, gone): the sorted numbers of the lines that go, for every document with any."""
    texts = _texts(docs, id_col, text_col)
    lines = written(simhashes(texts, min_words), "lines")
    place = F.struct("d", "t", "line")
    known = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("d", "t", "line", "words", "fp", "m", *BAG_COLUMNS)])
    known = written(known.withColumns({c: F.expr(_johnson(c)) for c in BAG_COLUMNS}), "distinct_lines")
    # all occurrences of lines that repeat, to find the first
    repeated = _small(known.where("n > 1").select("h1", "h2"), small)
    again = written(lines.select("h1", "h2", "d", "t", "line").join(repeated, ["h1", "h2"]), "repeated")
    release(lines)
    firsts = _small(written(again.groupBy("h1", "h2").agg(F.min(place).alias("first")), "firsts"), small // 2)
    # what a key's head is like comes first; then only pairs of different groups are left to find
    laid = lambda *extra: keyed(known.select("h1", "words", "fp", "m", *BAG_COLUMNS), least_shared, extra)
    shared = laid().groupBy("key").agg(F.min("h1").alias("head"), F.max("h1").alias("last")).where("head <> last").select("key", "head")
    shared = written(shared, "shared_keys")
    buckets = written(laid("fp", "words", *BAG_COLUMNS).join(_small(shared, small), "key"), "buckets")

    def near(a: str, b: str) -> Column:
        edits = f"cast(floor({1 - similarity:.6f} * greatest({a}words, {b}words) + 1e-9) as int)"
        return F.expr(f"bit_count({a}fp ^ {b}fp) <= {budget} AND abs({a}words - {b}words) <= {edits} AND {_bags_apart(a, b)} <= 2 * {edits}")

    heads = buckets.where("h1 = head").select("key", *[F.col(c).alias(f"head_{c}") for c in ("fp", "words", *BAG_COLUMNS)])
    stars = buckets.where("h1 <> head").join(heads, "key").where(near("", "head_"))
    stars = written(stars.select(F.col("head").alias("a"), F.col("h1").alias("b")).distinct(), "stars")
    linked = verified(stars, texts, known, firsts, similarity, small)
    groups = written(components(linked, "a", "b"), "groups").withColumnsRenamed({"node": "h1", "root": "g"})
    grouped = buckets.join(groups, "h1", "left").select("key", "h1", "fp", "words", *BAG_COLUMNS, "head", F.coalesce("g", "h1").alias("g"))
    mixed = grouped.groupBy("key").agg(F.min("g").alias("x"), F.max("g").alias("y")).where("x <> y").select("key")
    grouped = written(grouped.where("h1 <> head").join(mixed, "key", "left_semi"), "mixed")
    a, b = grouped.alias("a"), grouped.alias("b")
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.h1") < F.col("b.h1")) & (F.col("a.g") != F.col("b.g"))
    rest = written(a.join(b, on & near("a.", "b.")).select(F.col("a.h1").alias("a"), F.col("b.h1").alias("b")).distinct(), "rest")
    release(shared, buckets, grouped)
    if not rest.isEmpty():
        linked = linked.unionByName(verified(rest, texts, known, firsts, similarity, small))
        groups = components(linked, "a", "b").withColumnsRenamed({"node": "h1", "root": "g"})
    # of a group the first occurrence stays
    groups = _small(written(groups, "groups"), small // 2)
    placed = written(_placed(known.join(groups, "h1"), firsts).select("h1", "g", "first"), "placed")
    best = placed.groupBy("g").agg(F.min("first").alias("best"))
    gone = placed.join(best, "g").where(F.col("first") != F.col("best")).select("first.d", "first.t", "first.line")
    # and of equal lines
    rest = again.join(firsts, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first"))).select("d", "t", "line")
    return written(gone.unionByName(rest).groupBy("d", "t").agg(F.sort_array(F.collect_set("line")).alias("gone")), "gone")


def _joined(docs: DataFrame, id_col: str, text_col: str, small: int = 1_000_000, **options) -> tuple[DataFrame, Column, str]:
    """docs with their lines to drop; the column of those, and that column's name."""
    gone = dropped_lines(docs, id_col, text_col, small=small, **options)
    d, t, g = fresh(docs, "d", "t", "gone")
    gone = gone.withColumnsRenamed({"d": d, "t": t, "gone": g})
    same = F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(t))
    return docs.join(_small(gone, small // 4), same, "left"), F.coalesce(F.col(g), F.expr("cast(array() as array<int>)")), g


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id_col, n_lines, kept): every row's number of lines and the sorted numbers of those that stay."""
    rows, gone, _ = _joined(docs.select(id_col, text_col), id_col, text_col, **options)
    n = F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"))
    return rows.select(id_col, n.alias("n_lines"), F.array_except(F.sequence(F.lit(0), n - 1), gone).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with their texts reduced to the lines that stay; null texts stay null."""
    rows, gone, name = _joined(docs, id_col, text_col, **options)
    lines = F.split(F.col(text_col), "\n")
    kept = F.filter(F.arrays_zip(lines.alias("s"), F.sequence(F.lit(0), F.size(lines) - 1).alias("i")), lambda x: ~F.array_contains(gone, x["i"]))
    text = F.array_join(F.transform(kept, lambda x: x["s"]), "\n")
    # a text that loses no line stays as it is
    text = F.when(F.col(text_col).isNull() | F.col(name).isNull(), F.col(text_col)).otherwise(text)
    return rows.withColumn(text_col, text).select(*[f"`{c}`" for c in docs.columns])
