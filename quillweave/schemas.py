"""Table schemas, value domains and defaults."""

from __future__ import annotations

# Entity types, tags, relation labels, pairs in scope, markers.
GENE, DISEASE, CHEMICAL = "Gene", "Disease", "Chemical"
ENTITY_TYPES = (GENE, DISEASE, CHEMICAL)
TAGS = ("O", "B-Gene", "I-Gene", "B-Disease", "I-Disease", "B-Chemical", "I-Chemical")
IGNORED_TAG = -100
NO_RELATION = "None"
RELATION_LABELS = ("None", "Association", "Positive_Correlation", "Negative_Correlation")
#: Head types come before tail types in this order.
HEAD_ORDER = {"Gene": 0, "Chemical": 1, "Disease": 2}
HEAD_MARKS, TAIL_MARKS = ("[E1]", "[/E1]"), ("[E2]", "[/E2]")

# Types of the annotated corpus and what they are here.
CORPUS_ENTITY_TYPES = {
    "GeneOrGeneProduct": "Gene",
    "DiseaseOrPhenotypicFeature": "Disease",
    "ChemicalEntity": "Chemical",
}
CORPUS_RELATION_TYPES = {
    "Association": "Association",
    "Positive_Correlation": "Positive_Correlation",
    "Negative_Correlation": "Negative_Correlation",
    "Bind": "Association",
    "Cotreatment": "Association",
    "Comparison": "Association",
    "Drug_Interaction": "Association",
    "Conversion": "Association",
}
CORPUS_SPLITS = ("Train", "Dev", "Test")

# Defaults.
MIN_CONFIDENCE = 0.5
RECENT_YEARS, TREND_MIN_DOCS = 5, 2
QUERY_LIMIT, FIND_LIMIT, EVIDENCE_LIMIT, TREND_LIMIT, LANGUAGES_SHOWN = 25, 10, 5, 15, 15
RATE_PER = 1000.0
FIRST_YEAR, LAST_YEAR = 1800, 2100
SCOPE_FULL, SCOPE_TITLE, SCOPE_NONE = "title+abstract", "title", "none"

DOCUMENTS = (
    "pmid string, title string, abstract string, year int, languages array<string>, journal string, vernacular_title string, "
    "other_abstracts array<struct<language:string,text:string>>, query_label string, nlp_scope string, extracted boolean"
)
ARTICLES = (
    "pmid string, title string, abstract string, year int, languages array<string>, journal string, vernacular_title string, "
    "other_abstracts array<struct<language:string,text:string>>"
)
ENTITIES = "entity_id string, type string, name string, matched boolean"
MENTIONS = "pmid string, sentence_index int, start_char int, end_char int, surface string, type string, entity_id string"
RELATIONS = "pmid string, sentence_index int, head_id string, tail_id string, label string, confidence double, sentence string"
SEARCH_COUNTS = "label string, year int, kind string, total int, retrieved int"
LEXICON = "type string, surface string, entity_id string, name string, priority int, ordinal long"
SPANS = "array<struct<start:int,end:int,label:string,text:string>>"
GRAPH_TABLES = ("edges", "edge_years", "entity_stats", "entity_years", "year_docs")
BASE_TABLES = ("documents", "mentions", "relations", "entities")


def check_years(since: int | None, until: int | None = None) -> None:
    """Refuse years out of range and windows that end before they begin."""
    if any(y is not None and not FIRST_YEAR <= y <= LAST_YEAR for y in (since, until)):
        raise ValueError(f"years must be from {FIRST_YEAR} to {LAST_YEAR}")
    if since is not None and until is not None and until < since:
        raise ValueError("the window ends before it begins")


def check_choice(value: str | None, allowed: tuple[str, ...], what: str) -> None:
    if value is not None and value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}, not {value!r}")


def check_least(value: int, least: int, what: str) -> None:
    if value < least:
        raise ValueError(f"{what} must be at least {least}")
