"""Lexical, vector and metadata similarity, and size-capped clustering."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

# The parameters of lexical scoring and clustering.
K1, B = 1.5, 0.75
THRESHOLD, MAX_CLUSTER = 0.22, 75
#: Documents from which the dense formulation is no longer offered for scoring all pairs.
MAX_DENSE = 200_000


def term_table(docs: DataFrame, id_col: str, text_col: str, group: list[str] | None = None) -> DataFrame:
    """(group..., doc, term, tf, len): one row for each term of a document."""
    group = group or []
    toks = docs.select(*group, F.col(id_col).alias("doc"), T.tokens(F.col(text_col)).alias("_t"))
    rows = toks.select(*group, "doc", F.size("_t").alias("len"), F.explode("_t").alias("term"))
    return rows.groupBy(*group, "doc", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("len").alias("len"))


def corpus_stats(docs: DataFrame, id_col: str, text_col: str, group: list[str] | None = None) -> DataFrame:
    """n documents (empty ones count) and their mean length (1 where 0)."""
    group = group or []
    sized = docs.select(*group, F.size(T.tokens(F.col(text_col))).alias("_len"))
    return sized.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.avg("_len").alias("avg_len")).withColumn("avg_len", F.when(F.col("avg_len") == 0, 1.0).otherwise(F.col("avg_len")))


def bm25_weights(docs: DataFrame, id_col: str, text_col: str, group: list[str] | None = None) -> DataFrame:
    """(group..., doc, term, tf, idf, weight): weight is a term's contribution for one query occurrence."""
    group = group or []
    terms = term_table(docs, id_col, text_col, group)
    df = terms.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("df"))
    stats = corpus_stats(docs, id_col, text_col, group)
    joined = terms.join(df, [*group, "term"])
    joined = joined.join(stats, group) if group else joined.crossJoin(F.broadcast(stats))  # one row
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len")))
    return joined.select(*group, "doc", "term", "tf", idf.alias("idf"), weight.alias("weight"))


def bm25_pairs(docs: DataFrame, id_col: str, text_col: str, group: list[str] | None = None) -> DataFrame:
    """(group..., i, j, score): i < j, the two directions added, pairs that share a term.

    An inverted-index join on the term; each direction sums query multiplicity times weight.
    """
    group = group or []
    w = bm25_weights(docs, id_col, text_col, group)
    a, b = w.alias("a"), w.alias("b")
    on = F.col("a.term") == F.col("b.term")
    for g in group:
        on = on & (F.col(f"a.{g}") == F.col(f"b.{g}"))
    both = F.col("a.tf") * F.col("b.weight") + F.col("b.tf") * F.col("a.weight")
    return a.join(b, on & (F.col("a.doc") < F.col("b.doc"))).groupBy(*[F.col(f"a.{g}").alias(g) for g in group], F.col("a.doc").alias("i"), F.col("b.doc").alias("j")).agg(F.sum(both).alias("score"))


def normalised(pairs: DataFrame) -> DataFrame:
    """Scores over the greatest one (0 where that is 0)."""
    top = pairs.agg(F.max("score").alias("_top"))
    return pairs.crossJoin(F.broadcast(top)).withColumn("lexical", F.when(F.col("_top") > 0, F.col("score") / F.col("_top")).otherwise(0.0)).drop("_top")  # one row


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    na, nb = F.sqrt(dot(a, a)), F.sqrt(dot(b, b))
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb)).otherwise(0.0)


def fused(lexical: Column, cos: Column) -> Column:
    return 0.5 * lexical + 0.5 * F.greatest(F.lit(0.0), cos)


def _jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when(both > 0, both / F.size(F.array_union(a, b))).otherwise(0.0)


def affinity(topics_a: Column, topics_b: Column, entities_a: Column, entities_b: Column, group_a: Column, group_b: Column) -> Column:
    """Shared topics and entities by Jaccard, a quarter each, and a tenth for one independence group."""
    low = lambda xs: F.transform(xs, F.lower)
    return 0.25 * _jaccard(topics_a, topics_b) + 0.25 * _jaccard(low(entities_a), low(entities_b)) + F.when(group_a == group_b, 0.1).otherwise(0.0)


def all_pairs(items: DataFrame, id_col: str, block_rows: int = 1000) -> DataFrame:
    """(a, b): structs of the items of every pair with a's id under b's, gaps or not.

    Ids are hashed to blocks of about ``block_rows``; a row goes to each block pair it has a part in, so no table is
    broadcast and no key is hot. The pairs grow with the square of the rows.
    """
    blocks = max(4, -(-items.count() // block_rows))
    tasks = min(blocks**2, 2048)  # set here, as the work is in the pairs and not in the bytes moved
    row = F.struct(*items.columns)
    home, others = F.pmod(F.xxhash64(id_col), F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))
    a = items.select(row.alias("a"), home.alias("_p"), others.alias("_q"))
    b = items.select(row.alias("b"), home.alias("_q"), others.alias("_p"))
    dealt = a.repartition(tasks, "_p", "_q").join(b.repartition(tasks, "_p", "_q"), ["_p", "_q"])
    return dealt.where(F.col(f"a.{id_col}") < F.col(f"b.{id_col}")).select("a", "b")


def match_candidates(docs: DataFrame, id_col: str, text_col: str, batch: list[str], top_k: int = 6) -> DataFrame:
    """Groups of statements to judge together: each one's top_k - 1 neighbours in its batch, sets once.

    Two or fewer statements are one group. Ties go to the larger id; equal groups keep the first.
    """
    pairs = bm25_pairs(docs, id_col, text_col, batch)
    near = pairs.select(*batch, F.col("i").alias("_a"), F.col("j").alias("_b"), "score").unionByName(pairs.select(*batch, F.col("j").alias("_a"), F.col("i").alias("_b"), "score")).where("score > 0")
    rank = F.row_number().over(Window.partitionBy(*batch, "_a").orderBy(F.desc("score"), F.desc("_b")))
    top = near.withColumn("_r", rank).where(F.col("_r") <= top_k - 1)
    groups = top.groupBy(*batch, "_a").agg(F.collect_set("_b").alias("_bs")).select(*batch, "_a", F.array_sort(F.array_union(F.array("_a"), "_bs")).alias("ids"))
    small = docs.groupBy(*batch).agg(F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list(id_col)).alias("ids")).where("_n <= 2")
    first = F.row_number().over(Window.partitionBy(*batch, "ids").orderBy("_a"))
    big = docs.groupBy(*batch).agg(F.count(F.lit(1)).alias("_n")).where("_n > 2").select(*batch)
    kept = groups.join(big, batch, "left_semi").where(F.size("ids") > 1).withColumn("_f", first).where("_f = 1")
    return kept.select(*batch, "ids").unionByName(small.select(*batch, "ids"))


def connected(edges: DataFrame, vertices: DataFrame, checkpoint) -> DataFrame:
    """(id, component): smallest id reachable, by label passing with shortcuts; ``checkpoint`` cuts lineage."""
    both = checkpoint(edges.select("i", "j").unionByName(edges.select(F.col("j").alias("i"), F.col("i").alias("j"))))
    labels = checkpoint(vertices.select("id", F.col("id").alias("component")))
    while True:
        low = both.join(labels.withColumnRenamed("id", "j"), "j").groupBy(F.col("i").alias("id")).agg(F.min("component").alias("_m"))
        step = labels.join(low, "id", "left").select("id", F.least("component", F.coalesce("_m", "component")).alias("component"), F.col("component").alias("_old"))
        step = checkpoint(step)
        hop = step.toDF("_at", "_far", "_was")
        after = checkpoint(step.join(hop, F.col("component") == F.col("_at"), "left").select("id", F.least(F.col("component"), F.coalesce("_far", "component")).alias("component"), "_old"))
        if after.where("component <> _old").isEmpty():
            return after.select("id", "component")
        labels = after.select("id", "component")


def capped_merge(n_ids: list, edges: list[tuple[float, int, int]], most: int = MAX_CLUSTER) -> dict:
    """Greedy merging by falling (score, i, j); a merge over ``most`` members is skipped."""
    parent = {v: v for v in n_ids}
    size = dict.fromkeys(n_ids, 1)

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for _, i, j in sorted(edges, reverse=True):
        a, b = find(i), find(j)
        if a != b and size[a] + size[b] <= most:
            parent[max(a, b)] = min(a, b)
            size[min(a, b)] += size.pop(max(a, b))
    return {v: find(v) for v in n_ids}


def clusters(edges: DataFrame, vertices: DataFrame, checkpoint, threshold: float = THRESHOLD, most: int = MAX_CLUSTER) -> DataFrame:
    """(id, root, n): clusters of ids joined by edges (i, j, score) at or over the threshold, at most ``most`` each.

    Merges never leave a connected component, so components within the cap are final; only
    larger ones are merged greedily, each in a task of its own.
    """
    strong = checkpoint(edges.where(F.col("score") >= threshold).select("i", "j", F.col("score").cast("double").alias("score")))
    comp = connected(strong, vertices, checkpoint)
    sizes = comp.groupBy(F.col("component").alias("_c")).agg(F.count(F.lit(1)).alias("n"))
    sized = checkpoint(comp.join(sizes, F.col("component") == F.col("_c")).select("id", "component", "n"))
    small = sized.where(F.col("n") <= most).select("id", F.col("component").alias("root"))
    big = sized.where(F.col("n") > most).select("id", "component")
    home = big.select(F.col("id").alias("_i"), F.col("component").alias("_home"))
    inner = checkpoint(strong.join(home, F.col("i") == F.col("_i")).select(F.col("_home").alias("home"), "i", "j", "score"))

    def merge(key, members: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        roots = capped_merge(members["id"].tolist(), list(zip(links["score"], links["i"], links["j"])), most)
        return pd.DataFrame({"id": list(roots), "root": list(roots.values())})

    kind = dict(vertices.dtypes)["id"]
    split = big.groupBy("component").cogroup(inner.groupBy("home")).applyInPandas(merge, f"id {kind}, root {kind}")
    named = checkpoint(small.unionByName(split))
    return named.join(named.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")), "root")


def number_clusters(named: DataFrame) -> DataFrame:
    """cluster_id cl-001, cl-002, ... by falling size, then smallest member; one window over clusters, not members."""
    tops = named.select("root", "n", "first").distinct()
    number = F.row_number().over(Window.orderBy(F.desc("n"), "first"))
    return named.join(tops.select("root", F.format_string("cl-%03d", number).alias("cluster_id")), "root").select("id", "cluster_id", "n")
