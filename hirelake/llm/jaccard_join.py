"""N-gram Jaccard join by the size-aware heavy-light method.

A document's set is its distinct runs of ``k`` words.  Two documents link when
``den * |x & y| >= num * |x | y|``.

* Equal sets are collapsed first; the smallest id stands for its class.
* Small sets (light): every subset of the size a link needs is enumerated, for
  each partner size, and sets that share a subset are linked without more ado.
* Large sets (heavy): their inverted lists are scanned.  A set is listed under
  its first ``n - ceil(t n) + 1`` elements in one global order, rare ones first;
  linked sets must meet in a list.  Pairs are counted and pruned by an exact
  bound, and what is left is verified on the whole texts.
* The boundary between the two is the size with the least estimated cost.

Lists of thousands of near copies are not expanded into all pairs: each member
is first compared with the list's pivot, and only lists that still hold several
components are scanned for pairs across components.  No link between different
components is lost, so the components are exact.

Defined results: a null or wordless text has an empty set and links with
nothing; a text of fewer than ``k`` words is one shingle; repeated rows link
(equal sets); a null id gets its size and a null component; an empty table
gives an empty result; extra columns are ignored.  ``jaccard_components`` takes ids
as unique; ``jaccard_by_row`` tells rows apart by their place in the files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import common as C

SMALL_MAX = 20        # sets up to this size may be enumerated
LIST_LONG = 12        # an element with more sets goes to the end of the order
ORDER_MAX = 1_000_000  # of these, the most frequent so many (8 MB broadcast)
PIVOTS = 8            # nearest pivots that a member of a long list is compared with first


@dataclass(frozen=True)
class Rule:
    """Link rule: ``den * overlap >= num * union`` over ``k``-word shingles."""

    k: int = 5
    num: int = 80
    den: int = 100

    def overlap(self, n: int, m: int) -> int:
        """Least overlap with which sets of sizes n and m link."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def least(self, n: int) -> int:
        """Smallest partner size, and least overlap with any partner."""
        return -(-self.num * n // self.den)

    def prefix(self, n: int) -> int:
        return n - self.least(n) + 1

    def partners(self, n: int, top: int) -> range:
        return range(max(1, self.least(n)), min(top, n * self.den // self.num) + 1)

    def subsets(self, n: int, top: int) -> int:
        return sum(comb(n, self.overlap(n, m)) for m in self.partners(n, top))


def _first(s: np.ndarray, p: int, late: np.ndarray) -> np.ndarray:
    """The first ``p`` elements of a sorted set in the global order: by hash,
    those of ``late`` after all others."""
    if len(late) and p:
        is_late = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
        if is_late[:p].any():
            s = np.concatenate([s[~is_late], s[is_late]])
    return s[:p]


def _sketch(s: np.ndarray) -> np.ndarray:
    """256 bits, each flipped by the elements that hash to it.  Two sketches
    differ in at most as many bits as the sets differ in elements."""
    bit = (C.mix64(s + C.U(5)) >> C.U(56)).astype(np.int64)
    odd = np.bincount(bit, minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """(id, n, f1, f2, small, prefix): size, fingerprint, the whole set when it
    is small, and the first elements by hash."""
    none = np.zeros(0, C.U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, f1, f2, small, prefix = [], [], [], [], []
            for s in C.shingle_sets(batch.column(1), rule.k):
                size.append(len(s))
                f1.append(np.bitwise_xor.reduce(C.mix64(s)).view(np.int64) if len(s) else 0)
                f2.append(s.sum(dtype=C.U).view(np.int64) if len(s) else 0)
                small.append(s.view(np.int64) if len(s) <= SMALL_MAX else None)
                prefix.append(_first(s, rule.prefix(len(s)) if len(s) else 0, none).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(size, pa.int32()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                pa.array(small, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64()))],
                names=["id", "n", "f1", "f2", "small", "prefix"])

    return docs.mapInArrow(run, "id long, n int, f1 long, f2 long, small array<long>, prefix array<long>")


def _ordered(docs: DataFrame, rule: Rule, late: np.ndarray) -> DataFrame:
    """(id, n, prefix, b0..b3): the first elements in the global order, and the sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(late)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, prefix, bits = [], [], []
            for s in C.shingle_sets(batch.column(1), rule.k):
                size.append(len(s))
                prefix.append(_first(s, rule.prefix(len(s)) if len(s) else 0, shared.value).view(np.int64))
                bits.append(_sketch(s))
            bits = np.array(bits, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(size, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                *[pa.array(bits[:, i]) for i in range(4)]], names=["id", "n", "prefix", "b0", "b1", "b2", "b3"])

    return docs.mapInArrow(run, "id long, n long, prefix array<long>, b0 long, b1 long, b2 long, b3 long")


def _boundary(sizes: dict[int, int], list_length: float, rule: Rule) -> int:
    """Size up to which sets are enumerated: least estimated rows in all."""
    def cost(b: int) -> float:
        light = sum(h * rule.subsets(n, b) for n, h in sizes.items() if n <= b)
        heavy = sum(h * rule.prefix(n) * (1 + list_length) for n, h in sizes.items() if n >= rule.least(b + 1))
        return light + heavy

    return min(range(SMALL_MAX, -1, -1), key=cost)


def _light_links(small: DataFrame, rule: Rule, top: int) -> DataFrame:
    """Links between sets of at most ``top`` elements: they share a subset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, lows = [], [], []
            for i, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                e = C.mix64(np.array(s, np.int64).view(C.U))
                n = len(e)
                for m in rule.partners(n, top):
                    picks = np.array(list(combinations(range(n), rule.overlap(n, m))), np.int64)
                    tag = C.U(min(n, m) * 1000 + max(n, m))
                    keys.append(C.mix64(e[picks].sum(axis=1, dtype=C.U) + tag).view(np.int64))
                    ids.append(np.full(len(picks), i))
                    lows.append(np.full(len(picks), n <= m))
                    if n == m:  # a partner of equal size stands on both sides
                        keys.append(keys[-1])
                        ids.append(ids[-1])
                        lows.append(np.zeros(len(picks), bool))
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (ids, keys, lows)], names=["id", "key", "low"])

    rows = small.select("id", "small").mapInArrow(run, "id long, key long, low boolean")
    ends = rows.groupBy("key").agg(
        F.min(F.when(F.col("low"), F.col("id"))).alias("lo"), F.min(F.when(~F.col("low"), F.col("id"))).alias("hi"))
    ends = ends.filter("lo is not null and hi is not null")
    met = rows.join(ends, "key")
    return met.select(F.col("id").alias("a"), F.when(F.col("low"), F.col("hi")).otherwise(F.col("lo")).alias("b")) \
        .filter("a <> b").distinct()


#: SQL: number of bits in which the sketches of a and b differ.
APART = " + ".join(f"bit_count(a.b{i} ^ b.b{i})" for i in range(4))


def _may_link(rule: Rule, top: int) -> str:
    """SQL over two listed rows a and b, exact: sizes that allow a link, one of
    them large, sketches that differ in few bits, and enough elements from the
    common one on."""
    both = rule.num + rule.den
    return (f"least(a.n, b.n) * {rule.den}L >= greatest(a.n, b.n) * {rule.num}L and (a.n > {top} or b.n > {top}) "
            f"and ({APART}) * {both}L <= (a.n + b.n) * {rule.den - rule.num}L "
            f"and (least(a.pos, b.pos) + 1 + least(a.n - 1 - a.pos, b.n - 1 - b.pos)) * {both}L >= {rule.num}L * (a.n + b.n)")


def _counted(pairs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b, h), pruned by the number c of common listed elements.

    After the last common listed element of both, a common element must lie
    behind it in both sets, and behind the whole listed part of one of them.
    """
    g = pairs.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("c"), F.max("na").alias("na"), F.max("nb").alias("nb"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.max("h").alias("h"))
    rest = lambda n: f"(({n} * {rule.num}L + {rule.den - 1}L) div {rule.den}L - 1)"  # noqa: E731  n less its listed part
    return g.filter(
        f"(c + least(least(na - 1 - pa, nb - 1 - pb), greatest({rest('na')}, {rest('nb')}))) * {rule.num + rule.den}L "
        f">= {rule.num}L * (na + nb)").select("a", "b", "h")


def _verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that link, by the overlap of their whole texts."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    ids = C.stored(ids, "ids")
    texts = docs.join(C.broadcast_if_few(ids), "id", "left_semi")
    both = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(C.shingle_sets(batch.column(2), rule.k), C.shingle_sets(batch.column(3), rule.k)):
                o = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(o) and rule.den * o >= rule.num * (len(x) + len(y) - o))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _stars(links: DataFrame) -> DataFrame:
    """Fewer links with the same components: of all b that an a is linked with, the
    smallest stays its partner and is linked with the others, which many a share."""
    ends = links.groupBy("a").agg(F.sort_array(F.collect_set("b")).alias("bs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, bs = batch.column(0).to_numpy(), batch.column(1)
            off = bs.offsets.to_numpy().astype(np.int64)
            off, b = off - off[0], bs.values.to_numpy()[off[0]: off[-1]]
            least = b[off[:-1]]
            more = np.ones(len(b), bool)
            more[off[:-1]] = False
            pairs = np.stack([b[more], np.repeat(least, np.diff(off))[more]], axis=1)
            pairs = np.unique(np.concatenate([np.stack([own, least], axis=1), pairs]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return ends.mapInArrow(run, "a long, b long").distinct()


def _with_component(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """Rows with ``comp``: the component of ``id``, the id itself if unlinked."""
    if found is None:
        return rows.withColumn("comp", F.col("id"))
    return rows.join(C.broadcast_if_few(found), "id", "left").withColumn("comp", F.coalesce("_c", "id")).drop("_c")


def _components(links: DataFrame | None) -> DataFrame | None:
    return None if links is None else C.stored(C.components(links).select("id", F.col("component").alias("_c")), "components")


def _listed(ordered: DataFrame) -> DataFrame:
    """(token, id, pos) of the tokens that at least two sets list.  A bitmap of these
    goes to the tasks, so that tokens of one set only are never shuffled twice."""
    tokens = ordered.select(F.explode("prefix").alias("token"))
    often = C.stored(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1").select("token"), "met-tokens")
    shared = ordered.sparkSession.sparkContext.broadcast(C.bitmap(often, "token"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(1)
            off = col.offsets.to_numpy().astype(np.int64)
            token = col.values.to_numpy()[off[0]: off[-1]]
            row = np.repeat(np.arange(len(col)), np.diff(off))
            pos = np.arange(len(token)) - (off[:-1] - off[0])[row]
            ok = np.flatnonzero(C.in_bitmap(shared.value, token.view(C.U)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[ok]), pa.array(batch.column(0).to_numpy()[row[ok]]), pa.array(pos[ok].astype(np.int32))],
                names=["token", "id", "pos"])

    return ordered.select("id", "prefix").mapInArrow(run, "token long, id long, pos int")


def _heavy_links(docs: DataFrame, ordered: DataFrame, links: DataFrame | None, rule: Rule, top: int) -> DataFrame | None:
    """Links with a set of more than ``top`` elements, added to ``links``.

    ``ordered``: (id, n, prefix, b0..b3).  Two rounds, at every size: first each
    member of a list that holds several components meets the list's pivot, then the
    members of what lists still hold several components meet each other.  The lists
    are (token, id, pos); sizes and sketches join them for the pairs only.
    """
    about = ordered.select("id", "n", "b0", "b1", "b2", "b3")
    rest = C.stored(_listed(ordered), "lists")
    may = _may_link(rule, top)
    names = ("a.id as a", "b.id as b", "a.n as na", "b.n as nb", "a.pos as pa", "b.pos as pb", f"{APART} as h")
    found = _components(links)
    for last in (False, True):
        rest = C.stored(_with_component(rest, found), "lists")
        size = rest.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m"))
        size = size.groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("m2"))
        size = C.stored(size.filter("m * m > m2").select("token"), "open-lists")
        rest = C.stored(rest.join(size, "token"), "lists")
        if rest.isEmpty():
            return links
        full = C.stored(rest.join(about, "id"), "list-rows")
        if last:  # the pairs that are left, across components
            pairs = full.alias("a").join(full.alias("b"), F.expr(
                f"a.token = b.token and a.id < b.id and a.comp <> b.comp and {may}")).selectExpr(*names)
            pairs = _counted(pairs, rule)
        else:  # each member with a pivot of each of its lists, the nearest of these
            pick = full.groupBy("token").agg(F.min(F.struct(
                F.xxhash64("token", "id").alias("_h"), "id", "comp", "n", "pos", "b0", "b1", "b2", "b3")).alias("_x"))
            pairs = full.alias("a").join(pick.select("token", "_x.*").alias("b"), F.expr(
                f"a.token = b.token and a.comp <> b.comp and {may}")).selectExpr(*names)
            near = Window.partitionBy("a").orderBy("h", "b")  # at most a pivot per listed element
            # common elements are not counted here: b is the pivot of some of their lists only
            pairs = pairs.groupBy("a", "b").agg(F.max("h").alias("h")).withColumn("_r", F.row_number().over(near)).filter(F.col("_r") <= PIVOTS)
        new = C.stored(_stars(_verified(C.stored(pairs.select("a", "b"), "pairs"), docs, rule)), "links")
        links = new if links is None else links.unionByName(new)
        found = _components(links)
        rest = rest.drop("comp")
    return links


def jaccard_components(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) per row of ``docs``; stored."""
    with C.consumed(docs.sparkSession) as keep:
        return keep(_joined(docs, rule, id_col, text_col), "jaccard")


def jaccard_by_row(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same for rows of a file scan whose ids may be null or repeated: rows link,
    and the component is the smallest id of its rows (null if none has one)."""
    spark = docs.sparkSession
    with C.consumed(spark) as keep:
        rows = C.keyed(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")))
        found = jaccard_components(rows, rule, "key", "text")
        named = C.stored(found.join(rows.select("key", "id"), "key"), "row-components")
        least = named.groupBy("component_id").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"))
        out = C.join_unique(named, C.stored(least, "smallest-ids"), ["component_id"], "rows", named.count())
        return keep(out.select(F.col("id").alias(id_col), "n_shingles", F.col("least").alias("component_id")), "jaccard-rows")


def _joined(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = C.stored(_sets(C.spread_scan(docs), rule), "sets")
    df = sets.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("m"))
    long_lists = df.filter(F.col("m") > LIST_LONG).orderBy(F.desc("m"), "token").limit(ORDER_MAX).select("token")
    late = np.sort(np.array(long_lists.toPandas()["token"], np.int64).view(C.U))

    classes = C.stored(
        sets.filter("n > 0").groupBy("f1", "f2", "n").agg(
            F.min("id").alias("rep"), F.first("small").alias("small"), F.count(F.lit(1)).alias("rows")), "classes")
    histogram = {r.n: r.h for r in classes.filter(F.col("n") <= 2 * SMALL_MAX)
                 .groupBy("n").agg(F.count(F.lit(1)).alias("h")).collect()}
    top = _boundary(histogram, LIST_LONG / 2, rule)

    reps = C.stored(classes.filter("rep is not null").select(F.col("rep").alias("id"), "n", "small"), "representatives")
    light = reps.filter(F.col("n") <= top)
    links = C.stored(_stars(_light_links(light, rule, top)), "light-links") if any(n <= top for n in histogram) else None
    large = reps.filter(F.col("n") >= rule.least(top + 1)).select("id")
    texts = docs.filter("id is not null").join(C.broadcast_if_few(large), "id", "left_semi")
    ordered = C.stored(_ordered(C.spread_scan(texts.select("id", "text")), rule, late), "ordered")
    links = _heavy_links(docs.filter("id is not null"), ordered, links, rule, top)

    named = classes.select("f1", "f2", "n", "rows", F.col("rep").alias("id"))
    named = _with_component(named, _components(links)).select("f1", "f2", "n", "rows", "comp")
    total = sets.count()
    whole = C.join_unique(sets.filter("n > 0").select("id", "n", "f1", "f2"), named, ["f1", "f2", "n"], "rows", total)
    empty = sets.filter("n = 0").select("id", "n", "f1", "f2", F.col("id").alias("comp"))
    return whole.unionByName(empty.select(*whole.columns)).select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.col("comp")).alias("component_id"))


def oracle_sql(rule: Rule) -> str:
    """DuckDB SQL of ``jaccard_by_row`` over ``documents`` (unique ids), all pairs of a shingle."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= {rule.k}
      THEN list_transform(range(1, len(w) - {rule.k - 2}), lambda i: array_to_string(w[i:i + {rule.k - 1}], ' '))
      ELSE [array_to_string(w, ' ')] END)) AS sh
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE {rule.den} * o >= {rule.num} * (x.n + y.n - o)),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)"""
