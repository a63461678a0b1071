"""The versioned association graph and the walk that ranks what a change may affect.

Tables: run (version, created_at, ...), node (version, node_id, ...), edge (version, from_node,
to_node, weight, ...). The walk is a loop of at most ``max_hops`` joins over all inputs at once;
a frontier holds one best path for each (input, node). Unknown inputs give nothing; duplicate
edges count once (the strongest, ties by edge id); null weights are never walked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.functions.text import normalize_item
from lavra.session import staged


def latest_version(runs: DataFrame) -> DataFrame:
    """One row with the version of the newest run; ties by version, descending."""
    return runs.orderBy(F.desc("created_at"), F.desc("version")).limit(1).select("version")


def run_listing(runs: DataFrame) -> DataFrame:
    return runs.orderBy("created_at", "version")


def of_version(t: DataFrame, version: str | DataFrame) -> DataFrame:
    """Rows of a version; a version given as one row is joined, so that the filter needs no collect."""
    if isinstance(version, str):
        return t.filter(F.col("version") == version)
    return t.join(F.broadcast(version), "version", "left_semi")


def split_inputs(items: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, unknown) normalised items of a table (item)."""
    i = items.filter(F.trim("item") != "").select(normalize_item(F.col("item")).alias("item")).distinct()
    n = nodes.select(F.col("node_id").alias("item")).distinct()
    return i.join(n, "item", "left_semi"), i.join(n, "item", "left_anti")


def walkable(edges: DataFrame, min_weight: float = 0.05, relations: Sequence[str] | None = None, fan_out: int = 50) -> DataFrame:
    """The strongest edges of each node, each pair once."""
    e = edges.filter(F.col("weight") >= min_weight)
    if relations:
        e = e.filter(F.col("relation").isin(*relations))
    step = ["from_node", "to_node", "weight", "relation", "confidence", "lift", "documents", "edge_id", "cross_module"]
    e = e.select(*step).withColumn("_one", F.row_number().over(W.partitionBy("from_node", "to_node").orderBy(F.desc("weight"), "edge_id"))).filter("_one = 1").drop("_one")
    return e.withColumn("_r", F.row_number().over(W.partitionBy("from_node").orderBy(F.desc("weight"), "to_node"))).filter(F.col("_r") <= fan_out).drop("_r")


def is_term(node: Column) -> Column:
    return node.startswith("#")


def best_paths(known: DataFrame, edges: DataFrame, max_hops: int = 2, hop_penalty: float = 0.5) -> DataFrame:
    """(src, node, strength, hops, path, steps): the strongest path from each input to each node.

    At every hop only the best path of that hop to a node goes on; terms are reached but go on
    only when they are inputs. Ties go to the fewer hops, then to the smaller path.
    """
    step = F.struct(F.col("from_node").alias("from"), F.col("to_node").alias("to"), *[F.col(c) for c in ("relation", "weight", "confidence", "lift", "documents", "edge_id")], F.col("cross_module").cast("boolean").alias("cross_module"))
    frontier = known.select(F.col("item").alias("src"), F.col("item").alias("from_node"), F.lit(1.0).alias("strength"), F.array("item").alias("path"))
    steps = None
    found = None
    for hop in range(1, max_hops + 1):
        here = frontier if steps is None else steps
        j = here.join(edges, "from_node").filter(~F.array_contains("path", F.col("to_node")))
        s = F.col("strength") * F.col("weight") * (hop_penalty if hop > 1 else 1.0)
        before = F.col("steps") if hop > 1 else F.array().cast("array<struct<from:string,to:string,relation:string,weight:double,confidence:double,lift:double,documents:int,edge_id:bigint,cross_module:boolean>>")
        new = j.select("src", F.col("to_node").alias("node"), F.struct((-s).alias("d"), F.concat("path", F.array("to_node")).alias("path"), F.concat(before, F.array(step)).alias("steps")).alias("p"))
        best = staged(new.groupBy("src", "node").agg(F.min("p").alias("p")).select("src", "node", (-F.col("p.d")).alias("strength"), "p.path", "p.steps", F.lit(hop).alias("hops")), "walk")
        found = best if found is None else found.unionByName(best)
        steps = best.filter(~is_term(F.col("node"))).select("src", F.col("node").alias("from_node"), "strength", "path", "steps")
    best = found.groupBy("src", "node").agg(F.min(F.struct((-F.col("strength")).alias("d"), "hops", "path", "steps")).alias("p"))
    return best.select("src", "node", (-F.col("p.d")).alias("strength"), "p.hops", "p.path", "p.steps")


def combine(paths: DataFrame, known: DataFrame, include_terms: bool = False) -> DataFrame:
    """(node, score, hops, cross_module, paths): noisy-OR over the inputs; inputs are no candidates."""
    p = paths.join(known.select(F.col("item").alias("node")), "node", "left_anti")
    if not include_terms:
        p = p.filter(~is_term(F.col("node")))
    crossed = F.exists("steps", lambda s: s["cross_module"])
    detail = F.struct((-F.round("strength", 4)).alias("d"), F.col("src").alias("input"), F.round("strength", 4).alias("strength"), "path", "steps")
    g = p.groupBy("node").agg((1 - F.product(1 - F.col("strength"))).alias("score"), F.min("hops").alias("hops"), F.bool_or(crossed).alias("cross_module"), F.sort_array(F.collect_list(detail)).alias("paths"))
    return g


def rank_candidates(candidates: DataFrame, min_score: float = 0.02, limit: int = 15) -> DataFrame:
    return candidates.filter(F.col("score") >= min_score).orderBy(F.desc("score"), "node").limit(limit)


def explain(ranked: DataFrame, nodes: DataFrame, evidence: DataFrame, chunks: DataFrame, per_item: int = 2) -> DataFrame:
    """Candidates with their node's data and the evidence chunks of the strongest path's last edge."""
    last = F.element_at(F.element_at("paths", 1)["steps"], -1)["edge_id"]
    r = ranked.withColumn("last_edge", last)
    e = evidence.join(r.select(F.col("last_edge").alias("edge_id")).distinct(), "edge_id", "left_semi").join(chunks.select("chunk_id", "doc_name", "title", "pedido"), "chunk_id")
    e = e.withColumn("_r", F.row_number().over(W.partitionBy("edge_id").orderBy("rank"))).filter(F.col("_r") <= per_item)
    e = e.groupBy(F.col("edge_id").alias("last_edge")).agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", "chunk_id", "doc_name", "title", "pedido"))), lambda x: F.struct(x["chunk_id"].alias("chunk_id"), x["doc_name"].alias("doc_name"), x["title"].alias("title"), x["pedido"].alias("pedido"))).alias("evidence"))
    n = nodes.select(F.col("node_id").alias("node"), "node_type", "name", "module").dropDuplicates(["node"])
    return r.join(n, "node", "left").join(e, "last_edge", "left").drop("last_edge")


def find_impact_candidates(
    runs: DataFrame, nodes: DataFrame, edges: DataFrame, items: DataFrame, max_hops: int = 2, limit: int = 15, version: str | None = None, min_weight: float = 0.05,
    hop_penalty: float = 0.5, min_score: float = 0.02, relations: Sequence[str] | None = None, include_terms: bool = False,
) -> DataFrame:
    """Ranked candidates of a list of changed items (item) in one version of the graph, the latest by default."""
    v = version or latest_version(runs)
    known, _ = split_inputs(items, of_version(nodes, v))
    paths = best_paths(known, walkable(of_version(edges, v), min_weight, relations), max_hops, hop_penalty)
    return rank_candidates(combine(paths, known, include_terms), min_score, limit)


def chunk_text(chunks: DataFrame, chunk_id: str) -> DataFrame:
    """Text of one evidence chunk."""
    return chunks.filter(F.col("chunk_id") == chunk_id).select("text")


def recommend_by_confidence(edges: DataFrame, items: DataFrame, min_docs: int = 2, min_lift: float = 2.0, other_module_only: bool = False) -> DataFrame:
    """(node, score): noisy-OR of rule confidences over direct rules from the items; items are no candidates."""
    e = edges.filter((F.col("documents") >= min_docs) & (F.col("lift") >= min_lift))
    e = e.filter("cross_module = 1") if other_module_only else e
    i = items.select(normalize_item(F.col("item")).alias("from_node")).distinct()
    e = e.join(i, "from_node", "left_semi").groupBy("from_node", "to_node").agg(F.max("confidence").alias("confidence"))
    e = e.join(i.select(F.col("from_node").alias("to_node")), "to_node", "left_anti")
    return e.groupBy(F.col("to_node").alias("node")).agg((1 - F.product(1 - F.col("confidence"))).alias("score"))


def overview(edges: DataFrame, min_docs: int = 2, min_lift: float = 2.0, first: int = 60) -> DataFrame:
    """The strongest rules that pass the page's filters."""
    e = edges.filter((F.col("documents") >= min_docs) & (F.col("lift") >= min_lift)).dropDuplicates(["version", "from_node", "to_node"])
    return e.orderBy(F.desc("score"), "version", "from_node", "to_node").limit(first)


def edge_full(edges: DataFrame, nodes: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """Edges with the names of both ends, the module of the target and the evidence in rank order."""
    n = nodes.groupBy("version", "node_id").agg(F.min("name").alias("name"), F.min("module").alias("module"))
    e = edges.join(n.select("version", F.col("node_id").alias("from_node"), F.col("name").alias("from_name")), ["version", "from_node"], "left")
    e = e.join(n.select("version", F.col("node_id").alias("to_node"), F.col("name").alias("to_name"), F.col("module").alias("to_module")), ["version", "to_node"], "left")
    if evidence is None:
        return e
    lists = evidence.groupBy("edge_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "chunk_id"))), lambda x: x["chunk_id"]), " ").alias("evidence"))
    return e.join(lists, "edge_id", "left")


def referenced_chunks(chunks: DataFrame, evidence: DataFrame) -> DataFrame:
    """Chunks that support any rule."""
    return chunks.join(evidence.select("chunk_id").distinct(), "chunk_id", "left_semi")
