"""Divergence of sources within a language, over a quadtree of the group-term count matrix.

Groups are the (lang, source) pairs, terms those that enough documents of the language hold. The
matrix of counts is mostly zero, and a zero count has one probability per group. So the matrix is
cut into blocks of some groups and terms, dealt by hash, and a block is held as a k2-tree with k = 2:
per level a bitmap that says which of the four quadrants of each node hold a count at all, children
found by counting the bits before them, and the probabilities at the leaves. Two blocks of groups over the same
terms are walked together, level by level: a quadrant that is zero in both is left, and what its
terms give to each pair of groups is one product at the end; only where one of them has a count the
walk goes on, to the leaves in the end.

All arithmetic is on whole numbers.
"""

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlegrowth.llm.common import slices, stored, word_chunks

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP = 10
ROWS = 48  # groups of a block on the average
TERMS = 4096  # terms of a block on the average
LEAVES = 1 << 21  # pairs of leaves that are walked to at a time
MOST_HELD = 500_000  # terms that a task counts before it sends them

_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_DOC = 1 << 42  # a document, in a number that holds documents and occurrences


def term_counts(documents):
    """Rows (lang, source, term, count, docs): occurrences of each term in each group, and its
    documents. Terms are runs of letters A-Z, lower-cased, and of anything beyond ASCII. NULL in text,
    lang and source counts as ''."""

    def count(batches):
        held, size = {}, 0
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, source, text in zip(*(x.to_pylist() for x in part.columns)):
                    words = Counter()
                    for chunk in word_chunks((text or b"").translate(_LETTERS)):
                        words.update(chunk)
                    group = held.setdefault((lang, source), {})
                    size -= len(group)
                    for word, n in words.items():
                        group[word] = group.get(word, 0) + n + _DOC
                    size += len(group)
                if size >= MOST_HELD:
                    yield from sent(held)
                    held, size = {}, 0
        yield from sent(held)

    def sent(held):
        for (lang, source), group in held.items():
            if not group:
                continue
            numbers = np.fromiter(group.values(), dtype=np.int64, count=len(group))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(group)), pa.array([source] * len(group)),
                 pa.array(list(group), pa.binary()).cast(pa.string()),
                 pa.array(numbers % _DOC), pa.array(numbers // _DOC)],
                ["lang", "source", "term", "count", "docs"],
            )

    return _named(documents).select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        count, "lang string, source string, term string, count long, docs long"
    ).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _named(documents):
    return documents.select(
        *(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source", "text"))
    )


def share(count, total, terms):
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exactly; the columns are named."""
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10, 0)) * ({count} + 2)) div ({total} + 2 * {terms})"
    )


def gap(p, q):
    """floor((p - q)^2 / (p + q)) of two columns of shares."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


class Tree:
    """A k2-tree (k = 2) over points of a square of side 2^levels, or of a row of such squares."""

    def __init__(self, rows, columns, values, levels, squares):
        codes = (columns >> levels).astype(np.int64) << 2 * levels
        inner = columns & (1 << levels) - 1
        for bit in range(levels):
            codes |= (inner >> bit & 1) << 2 * bit | (rows >> bit & 1) << 2 * bit + 1
        order = np.argsort(codes, kind="stable")
        codes, self.values = codes[order], values[order]
        self.roots = np.full(squares, -1, dtype=np.int64)
        nodes = np.unique(codes >> 2 * levels)
        self.roots[nodes] = np.arange(len(nodes))
        self.bits, self.ranks = [], []
        for level in range(levels - 1, -1, -1):
            children = np.unique(codes >> 2 * level)
            bits = np.zeros(4 * len(nodes), dtype=bool)
            bits[4 * np.searchsorted(nodes, children >> 2) + (children & 3)] = True
            self.bits.append(bits)
            self.ranks.append(np.cumsum(bits) - 1)
            nodes = children

    def child(self, level, node, quadrant):
        """The number of a child among those of its level, -1 where the quadrant is zero."""
        if not len(self.bits[level]):
            return np.full(len(node), -1, dtype=np.int64)
        at = np.maximum(4 * node + quadrant, 0)
        return np.where((node >= 0) & self.bits[level][at], self.ranks[level][at], -1)


def walk(left, right, zero_left, zero_right, levels, squares, same):
    """Two trees over the same terms walked together: (i, j, sum of gaps over the terms that one of
    them has, number of these terms) for each pair of groups that has such terms.

    zero_left and zero_right are the shares of a zero count, one per group. With `same`, both trees
    are of the same groups and only i < j is visited.
    """
    n, m = len(zero_left), len(zero_right)
    total, met = np.zeros(n * m, dtype=np.int64), np.zeros(n * m, dtype=np.int64)
    step = max(1, LEAVES // max(1, n * m << levels))
    quadrants = np.array([[a, b, c] for a in (0, 1) for b in (0, 1) for c in (0, 1)])
    for start in range(0, squares, step):
        a, b = left.roots[start:start + step], right.roots[start:start + step]
        kept = (a >= 0) | (b >= 0)
        a, b = a[kept], b[kept]
        i, j = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64)
        for level in range(levels):
            size = 1 << levels - 1 - level
            found = []
            for di, dj, dc in quadrants.tolist():
                x, y = 2 * i + di, 2 * j + dj
                p = left.child(level, a, 2 * di + dc)
                q = right.child(level, b, 2 * dj + dc)
                kept = ((p >= 0) | (q >= 0)) & (x * size < n) & (y * size < m)
                if same:
                    kept &= x <= y if size > 1 else x < y
                found.append([z[kept] for z in (p, q, x, y)])
            a, b, i, j = (np.concatenate(z) for z in zip(*found))
        p = np.where(a >= 0, left.values[a] if len(left.values) else 0, zero_left[i])
        q = np.where(b >= 0, right.values[b] if len(right.values) else 0, zero_right[j])
        np.add.at(total, i * m + j, (p - q) ** 2 // (p + q))
        met += np.bincount(i * m + j, minlength=n * m)
    pairs = np.flatnonzero(met)
    return pairs // m, pairs % m, total[pairs], met[pairs]


def _walk_block(block: pd.DataFrame) -> pd.DataFrame:
    """The pairs of two blocks of groups (or of the groups of one) over one block of terms. Each
    group has one row without a term, so that groups that have none of these terms are there too."""
    counted = block["term"].notna().to_numpy()
    column, terms = pd.factorize(block["term"])
    shares, zeros, side = (block[x].to_numpy() for x in ("share", "zero", "side"))
    same = bool(block["same"].iloc[0])
    names, zero, points = [], [], []
    for k in (0,) if same else (0, 1):
        mine = side == k
        row, sources = pd.factorize(block["source"].to_numpy()[mine])
        names.append(np.asarray(sources, dtype=object))
        zero.append(np.zeros(len(sources), dtype=np.int64))
        zero[-1][row] = zeros[mine]
        held = counted[mine]
        points.append((row[held].astype(np.int64), column[mine][held].astype(np.int64), shares[mine][held]))
    levels = max(1, int(max(map(len, names)) - 1).bit_length())
    squares = (len(terms) - 1 >> levels) + 1
    if all(map(len, names)):
        trees = [Tree(*x, levels, squares) for x in points]
        i, j, total, met = walk(trees[0], trees[-1], zero[0], zero[-1], levels, squares, same)
    else:
        i = j = total = met = np.empty(0, dtype=np.int64)
    text = {"lang": [block["lang"].iloc[0]] * len(i), "a": names[0][i], "b": names[-1][j]}
    return pd.DataFrame({
        **{name: pd.Series(column, dtype=object) for name, column in text.items()},
        "total": total, "met": met,
    })


def pair_sums(groups, counted, rows=ROWS, terms=TERMS):
    """For pairs of groups with a < b: lang, a, b, total and met as `walk` gives them, over all terms.

    groups: lang, source, zero, sources (of the language), kept (terms of the language); counted:
    lang, source, term, share. Each block of groups goes to each other once, as the pairs are the
    result; a block of terms goes to one task per pair of blocks.
    """
    blocks = F.ceil(F.col("sources") / rows).cast("int")
    sized = groups.withColumn("blocks", blocks).withColumn(
        "row_block", F.expr("cast(pmod(xxhash64(source), blocks) as int)")
    ).withColumn("term_blocks", F.ceil(F.col("kept") / terms).cast("int"))
    entries = counted.join(
        sized.select("lang", "source", "zero", "blocks", "row_block", "term_blocks"), ["lang", "source"]
    ).withColumn("term_block", F.expr("cast(pmod(xxhash64(term), term_blocks) as int)"))
    heads = sized.where("term_blocks > 0").withColumn(
        "term_block", F.explode(F.expr("sequence(0, term_blocks - 1)"))
    ).withColumn("term", F.lit(None).cast("string")).withColumn("share", F.lit(None).cast("long"))
    wanted = ["lang", "source", "term", "share", "zero", "blocks", "row_block", "term_block"]
    met = entries.select(wanted).unionByName(heads.select(wanted)).withColumn(
        "other", F.explode(F.expr("sequence(0, blocks - 1)"))
    ).select(
        "lang", "source", "term", F.coalesce("share", F.lit(0)).alias("share"), "zero", "term_block",
        F.least("row_block", "other").alias("low"), F.greatest("row_block", "other").alias("high"),
        F.expr("if(row_block <= other, 0, 1)").alias("side"), F.expr("row_block = other").alias("same"),
    )
    sums = met.groupBy("lang", "low", "high", "term_block").applyInPandas(
        _walk_block, "lang string, a string, b string, total long, met long"
    )
    return sums.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.sum("total").alias("total"), F.sum("met").alias("met")
    )


def audit(documents, least=LEAST_DOCUMENTS, top=TOP):
    """Rows (lang, source, part, item, value, rank) for every group (lang, source) of the documents.

    Part `pair`: each other source of the language, by the sum of gaps between the shares of all kept
    terms. Part `term`: the `top` terms that the group has more of than its language, by their gap. Ranks
    begin with 1, larger values first, then items in the order of their bytes.

    Kept are the terms in `least` documents of the language or more. NULL in text, lang or source
    counts as ''. A group without terms is a group; a language without kept terms has pairs of
    value 0. Repeated rows are documents of their own, other columns are not read, and an empty
    table gives no rows.
    """
    counts = stored(term_counts(documents), "term_counts")
    terms = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("lang_count")
    ).where(F.col("docs") >= least).drop("docs")
    kept = stored(counts.drop("docs").join(terms, ["lang", "term"]), "kept_terms")
    vocabulary = kept.groupBy("lang", "term").agg(F.first("lang_count").alias("lang_count")).groupBy(
        "lang").agg(F.count("*").alias("kept"), F.sum("lang_count").alias("lang_total"))
    named = _named(documents).select("lang", "source").distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sources = named.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = (
        named.join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left").join(sources, "lang")
        .na.fill(0, ["total", "kept", "lang_total"])
        .withColumn("zero", F.when(F.col("kept") > 0, share(0, "total", "greatest(kept, 1)")).otherwise(0))
    )
    groups = stored(groups, "groups")
    counted = kept.join(groups.drop("zero", "sources"), ["lang", "source"]).select(
        "lang", "source", "term", share("count", "total", "kept").alias("share"),
        share("lang_count", "lang_total", "kept").alias("lang_share"),
    )
    counted = stored(counted, "shares")

    met = pair_sums(groups, counted.drop("lang_share"))
    left = groups.select("lang", F.col("source").alias("a"), F.col("zero").alias("zero_a"), "kept")
    right = groups.select("lang", F.col("source").alias("b"), F.col("zero").alias("zero_b"))
    pairs = left.join(right, "lang").where("a < b").join(met, ["lang", "a", "b"], "left").na.fill(
        0, ["total", "met"]
    ).withColumn("value", F.when(
        F.col("kept") > 0, F.col("total") + (F.col("kept") - F.col("met")) * gap("zero_a", "zero_b")
    ).otherwise(F.lit(0)).cast("long"))
    pair = pairs.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )).alias("one")).select("lang", "one.source", F.lit("pair").alias("part"), "one.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(order))
    term = counted.where("share > lang_share").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        gap("share", "lang_share").alias("value"),
    ).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term)


def op13_source_divergence(spark, sf_dir):
    """The sources of each language against each other, and what sets each apart from its language."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), words AS (
  SELECT row_id, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS lang_count FROM words
  GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), vocabulary AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(lang_count)::HUGEINT AS lang_n FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS c FROM words JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), totals AS (
  SELECT lang, source, sum(c)::HUGEINT AS n FROM counts GROUP BY lang, source
), full_counts AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (coalesce(t.n, 0) + 2 * v.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_count + 2)) // (v.lang_n + 2 * v.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN vocabulary v USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM full_counts a JOIN full_counts b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM full_counts WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 10
"""
