"""The graph as GraphML or node-link JSON, and metrics as JSON.

Both formats are one document. Rows come to the driver a partition at a time and are written as they come, so its memory
holds a partition of the exported graph, not all of it.
"""

from __future__ import annotations

import json
from pathlib import Path
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.plans.graph import KnowledgeGraph

FORMATS = ("graphml", "json")
NODE = (("name", "string"), ("type", "string"), ("normalized", "boolean"), ("n_docs", "long"))
EDGE = (("label", "string"), ("n_docs", "long"), ("mean_confidence", "double"), ("combined_confidence", "double"), ("first_year", "long"), ("last_year", "long"), ("years", "string"))


def year_map(years: str = "years"):
    """{"2010": 3, ...} of array<struct<year,n_docs>> as JSON."""
    return F.to_json(F.map_from_entries(F.transform(years, lambda x: F.struct(x["year"].cast("string"), x["n_docs"]))))


def nodes_json(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.to_json(F.struct(F.col("entity_id").alias("id"), "name", "type", "normalized", "n_docs")).alias("value"))


def links_json(edges: DataFrame) -> DataFrame:
    years = F.map_from_entries(F.transform("years", lambda x: F.struct(x["year"].cast("string"), x["n_docs"])))
    return edges.select(F.to_json(F.struct(F.col("head_id").alias("source"), F.col("tail_id").alias("target"), F.col("label").alias("key"), "label", "n_docs", "mean_confidence", "combined_confidence", "first_year", "last_year", years.alias("years"))).alias("value"))


def _attribute(v) -> str:
    return str(v).lower() if isinstance(v, bool) else str(v)


def export_graph(graph: KnowledgeGraph, path: str | Path, form: str = "graphml", min_docs: int = 1, since: int | None = None) -> tuple[int, int]:
    """Write the graph; the numbers of nodes and edges."""
    S.check_choice(form, FORMATS, "format")
    nodes, edges = graph.export_nodes(min_docs, since).orderBy("entity_id"), graph.export_edges(min_docs, since).orderBy("head_id", "tail_id", "label")
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    n_nodes = n_edges = 0
    with path.open("w", encoding="utf-8") as out:
        if form == "json":
            out.write('{"directed": true, "multigraph": true, "graph": {}, "nodes": [')
            for row in nodes_json(nodes).toLocalIterator():
                out.write(("," if n_nodes else "") + "\n " + row["value"])
                n_nodes += 1
            out.write('\n], "links": [')
            for row in links_json(edges).toLocalIterator():
                out.write(("," if n_edges else "") + "\n " + row["value"])
                n_edges += 1
            out.write("\n]}\n")
            return n_nodes, n_edges
        out.write('<?xml version="1.0" encoding="utf-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n')
        for kind, fields in (("node", NODE), ("edge", EDGE)):
            for name, t in fields:
                out.write(f'  <key id="{kind}_{name}" for="{kind}" attr.name="{name}" attr.type="{t}"/>\n')
        out.write('  <graph edgedefault="directed">\n')
        data = lambda kind, row, fields: "".join(f'<data key="{kind}_{n}">{escape(_attribute(row[n]))}</data>' for n, _ in fields if row[n] is not None)
        for row in nodes.toLocalIterator():
            out.write(f"    <node id={quoteattr(row['entity_id'])}>{data('node', row, NODE)}</node>\n")
            n_nodes += 1
        for row in edges.withColumn("years", year_map()).toLocalIterator():
            out.write(f"    <edge source={quoteattr(row['head_id'])} target={quoteattr(row['tail_id'])} id={quoteattr(row['label'])}>{data('edge', row, EDGE)}</edge>\n")
            n_edges += 1
        out.write("  </graph>\n</graphml>\n")
    return n_nodes, n_edges


def write_json(path: str | Path, payload: dict) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, indent=2, sort_keys=True) + "\n", encoding="utf-8")
