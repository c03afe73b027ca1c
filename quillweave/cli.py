"""Command line over a store: `python -m quillweave.cli --db DIR COMMAND ...`."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from quillweave import schemas as S
from quillweave.operators.dictionary import Dictionary
from quillweave.operators.store import Store
from quillweave.plans import ingest, pipeline
from quillweave.plans.extract import constant_classifier, dictionary_tagger
from quillweave.plans.graph import KnowledgeGraph
from quillweave.sinks.graph_files import FORMATS, export_graph, write_json
from quillweave.sources import entrez, lexicon, pubtator


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillweave")
    top.add_argument("--db", help="folder of the store")
    sub = top.add_subparsers(dest="command", required=True)
    add = lambda name: sub.add_parser(name)
    p = add("build-graph")
    p.add_argument("--min-confidence", type=float, default=S.MIN_CONFIDENCE)
    p = add("ingest")
    p.add_argument("--start", type=int, default=ingest.START)
    p.add_argument("--end", type=int, default=ingest.STOP)
    p.add_argument("--per-year", type=int, default=ingest.PER_YEAR)
    p.add_argument("--non-english", type=int, default=ingest.NON_ENGLISH_PER_YEAR)
    p.add_argument("--topic", action="append", choices=sorted(ingest.TOPICS))
    p.add_argument("--cache", required=True, help="file of the answers")
    p = add("extract")
    _models(p)
    p.add_argument("--limit", type=_at_least(1))
    p.add_argument("--batch-docs", type=_at_least(1), help="documents of one commit; all by default")
    p.add_argument("--redo", action="store_true")
    p = add("evaluate-pipeline")
    _models(p)
    p.add_argument("--corpus", required=True, help="folder of the annotated corpus")
    p.add_argument("--split", choices=S.CORPUS_SPLITS, default="Test")
    p.add_argument("--min-confidence", type=float, default=S.MIN_CONFIDENCE)
    p.add_argument("--out", help="file of the scores")
    for name in ("train-ner", "train-re"):
        p = add(name)
        p.add_argument("--corpus", required=True, help="folder of the annotated corpus")
        p.add_argument("--models", required=True, help="folder of the trained models")
        p.add_argument("--out", help="file of the scores")
    for name in ("download-corpus", "download-lexicons"):
        add(name).add_argument("--out", required=True, help="folder of the files")
    add("refresh-graph")
    add("vacuum").add_argument("--unused-hours", type=float, default=24.0)
    p = add("query")
    p.add_argument("--entity", required=True)
    p.add_argument("--since", type=int)
    p.add_argument("--until", type=int)
    p.add_argument("--label", choices=S.RELATION_LABELS[1:])
    p.add_argument("--min-docs", type=int, default=1)
    p.add_argument("--limit", type=int, default=S.QUERY_LIMIT)
    p.add_argument("--evidence", type=int, default=0)
    p = add("top")
    p.add_argument("--type", choices=S.ENTITY_TYPES)
    p.add_argument("--since", type=int)
    p.add_argument("--limit", type=int, default=S.QUERY_LIMIT)
    p = add("trends")
    p.add_argument("--entity")
    p.add_argument("--recent-years", type=int, default=S.RECENT_YEARS)
    p.add_argument("--min-docs", type=int, default=S.TREND_MIN_DOCS)
    p.add_argument("--limit", type=int, default=S.TREND_LIMIT)
    p = add("export")
    p.add_argument("--format", choices=FORMATS, default="graphml")
    p.add_argument("--out", required=True)
    p.add_argument("--min-docs", type=int, default=1)
    p.add_argument("--since", type=int)
    add("stats")
    return top


def _at_least(least: int):
    def number(text: str) -> int:
        if int(text) < least:
            raise argparse.ArgumentTypeError(f"must be at least {least}")
        return int(text)

    return number


def _models(p: argparse.ArgumentParser) -> None:
    """How names are found and pairs classified."""
    p.add_argument("--models", help="folder of trained models")
    p.add_argument("--terms", help="JSON object of terms and their types, to tag these without a trained tagger")
    p.add_argument("--dictionary", action="store_true", help="tag the names of the vocabularies, without a trained tagger")
    p.add_argument("--confidence", type=float, default=0.9, help="of every pair, without trained models")
    p.add_argument("--lexicons", required=True, help="folder of the vocabularies")


def pipeline_of(spark: SparkSession, args: argparse.Namespace) -> pipeline.Pipeline:
    if args.models:
        try:
            return pipeline.load_pipeline(spark, args.models, args.lexicons, args.dictionary)
        except FileNotFoundError as error:
            raise SystemExit(str(error)) from error
    vocabulary = lexicon.read_all(spark, args.lexicons)
    if args.dictionary:
        tagger = Dictionary(vocabulary)
    elif args.terms:
        tagger = dictionary_tagger(json.loads(Path(args.terms).read_text(encoding="utf-8")))
    else:
        raise SystemExit("one of --models, --dictionary and --terms is needed")
    return pipeline.Pipeline(tagger, constant_classifier("Association", args.confidence), vocabulary)


def corpus_splits(spark: SparkSession, folder: str) -> dict[str, pubtator.Corpus]:
    """The splits of a corpus that are there; Train must be."""
    there = [s for s in S.CORPUS_SPLITS if (Path(folder) / "BioRED" / f"{s}.PubTator").exists()]
    if "Train" not in there:
        raise SystemExit(f"{folder} holds no annotated corpus; download-corpus fetches it")
    return {s: pubtator.read_split(spark, s, folder) for s in there}


def shown(results: dict, out: str | None) -> list[str]:
    if out:
        write_json(out, results)
    return json.dumps(results, indent=2).splitlines()


#: Eight heights, by the share of the largest.
BARS = "▁▂▃▄▅▆▇█"


def sparkline(counts: Sequence[int]) -> str:
    """A bar for each number."""
    most = max(counts, default=0)
    return "".join(BARS[round((len(BARS) - 1) * n / most)] if most else BARS[0] for n in counts)


def entity(graph: KnowledgeGraph, term: str):
    row = graph.find_entities(term).first()
    if row is None:
        raise SystemExit(f"no entity matches {term!r}")
    return row


def years(series) -> str:
    return " ".join(f"{x['year']}:{x['n_docs']}" for x in series)


def run(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """The lines that a command prints."""
    if args.command in ("train-ner", "train-re"):
        train = pipeline.train_tagger if args.command == "train-ner" else pipeline.train_classifier
        return shown(train(spark, corpus_splits(spark, args.corpus), args.models), args.out)
    if args.command == "evaluate-pipeline":
        made = pipeline_of(spark, args)
        scores = pipeline.evaluate_pipeline(pubtator.read_split(spark, args.split, args.corpus), made.tagger, made.classifier, made.lexicon, args.min_confidence)
        return shown({"split": args.split, "min_confidence": args.min_confidence, **pipeline.scores(scores)}, args.out)
    if args.command == "download-corpus":
        archive = entrez.download(entrez.CORPUS_FILES, args.out, entrez.fetch)[0]
        return [f"{args.out}/{n}" for n in entrez.unpack_corpus(archive, args.out)]
    if args.command == "download-lexicons":
        return list(map(str, entrez.download(entrez.LEXICON_FILES, args.out, entrez.fetch)))
    if not args.db:
        raise SystemExit(f"{args.command} needs --db")
    store = Store(spark, args.db)
    if args.command == "ingest":
        chosen = {k: v for k, v in ingest.TOPICS.items() if not args.topic or k in args.topic}
        plan = ingest.plan_queries(ingest.topics(spark, chosen), args.start, args.end, args.per_year, args.non_english)
        documents, counts = ingest.run_ingest(spark, entrez.Service(entrez.Answers(args.cache)), plan)
        store.upsert(documents)
        store.append("search_counts", counts)
        return [f"{store.count('documents')} documents"]
    if not store.exists("documents"):
        raise SystemExit(f"{args.db} holds no documents")
    if args.command == "build-graph":
        return [f"{k}: {v}" for k, v in store.build_graph(args.min_confidence).items()]
    if args.command == "refresh-graph":
        sizes = store.refresh_graph()
        return [f"{k}: {v} buckets" for k, v in sizes.items()] or ["built"]
    if args.command == "vacuum":
        return [f"{store.vacuum(args.unused_hours * 3600)} folders removed"]
    if args.command == "extract":
        made = pipeline_of(spark, args)
        n = pipeline.extract_pending(store, made.tagger, made.classifier, made.lexicon, args.limit, args.redo, args.batch_docs)
        return [f"{n} documents extracted"]
    graph = store.graph()
    if args.command == "query":
        e = entity(graph, args.entity)
        out = [f"{e['name']} [{e['type']}, {e['entity_id']}] in {e['n_docs']} docs"]
        window = {"since": args.since, "until": args.until, "label": args.label, "min_docs": args.min_docs, "limit": args.limit}
        rows = (graph.neighbors_with_evidence(e["entity_id"], args.evidence, **window) if args.evidence else graph.neighbors(e["entity_id"], **window)).collect()
        for r in sorted(rows, key=lambda r: (-r["n_docs"], -r["mean_confidence"], r["neighbor_id"], r["label"])):
            out.append(f"{r['neighbor_name'][:32]:<32} {r['neighbor_type']:<9} {r['label']:<21} {r['n_docs']:>4} {r['mean_confidence']:>5.2f}  {r['first_year']}-{r['last_year']}")
            out += [f"    PMID {x['pmid']} ({x['year']}) {x['label']} {x['confidence']:.2f}: {x['sentence'][:220]}" for x in (r["evidence"] or [] if args.evidence else [])]
        return out if rows else [*out, "no associations in this window"]
    if args.command == "top":
        return [f"{r['n_docs']:>6}  {r['type']:<9} {r['name'][:40]:<40} {r['entity_id']}" for r in graph.top_entities(args.type, args.since, args.limit).collect()]
    if args.command == "trends":
        e = entity(graph, args.entity) if args.entity else None
        out = [] if e is None else [f"{e['name']}: " + "  ".join(f"{r['year']}:{r['n_docs']}({r['rate']:.0f})" for r in graph.entity_series(e["entity_id"]).collect())]
        rows = graph.edge_trends(e and e["entity_id"], args.recent_years, args.min_docs, args.limit).collect()
        return out + [f"{r['head_name'][:22]} -[{r['label'][:12]}]- {r['tail_name'][:20]}  {r['early_rate']:.1f} {r['recent_rate']:.1f} {r['rate_ratio']:.2f}  {sparkline([x['n_docs'] for x in r['series']])}  {years(r['series'])}" for r in rows]
    if args.command == "export":
        nodes, edges = export_graph(graph, args.out, args.format, args.min_docs, args.since)
        return [f"wrote {nodes} nodes / {edges} edges to {args.out}"]
    rate = graph.match_rate().first()
    out = [f"{r['table']}: {r['n']}" for r in graph.table_counts().collect()]
    out += [f"  language {r['languages']:<12} {r['n_docs']}" for r in graph.language_counts().collect()]
    out += [f"  nlp scope {r['nlp_scope']:<16} {r['n_docs']}" for r in graph.scope_counts().collect()]
    return [*out, f"mentions: {rate['n_mentions']} ({rate['match_rate']:.1%} normalised to a vocabulary id)"]


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    for line in run(SparkSession.builder.getOrCreate(), args):
        print(line)


if __name__ == "__main__":
    main()
