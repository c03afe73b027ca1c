"""Dictionary linking: vocabulary index, abbreviations, and mentions to entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillweave.functions.abbreviations import find_abbreviations
from quillweave.functions.keys import candidate_keys, lookup_keys, normalize_key
from quillweave.operators.shared import dealt

#: A key of singular words ranks below any key as it stands.
SINGULAR_PENALTY = 3


def lexicon_index(lexicon: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(type, key, entity_id, name): of the entries that share a key, the one of lowest priority, then the first read.

    `wanted` (type, key) restricts the index before it is aggregated; it is usually far smaller than the vocabulary. Exploding keeps
    rows without keys, here and below, until a condition on the key drops them: else the planner filters by the size of the keys
    before, and works them out once more, for mentions even in each of them, below the aggregation.
    """
    keyed = lexicon.select("type", "entity_id", "name", "priority", "ordinal", F.posexplode_outer(lookup_keys(F.col("surface"))).alias("rank", "key")).where("key <> ''")
    if wanted is not None:
        keyed = keyed.join(wanted.select("type", "key").distinct(), ["type", "key"], "left_semi")
    best = F.min(F.struct((F.col("priority") + SINGULAR_PENALTY * F.col("rank")).alias("p"), "ordinal", "rank", "entity_id", "name"))
    return keyed.groupBy("type", "key").agg(best.alias("b")).select("type", "key", "b.entity_id", "b.name")


def document_abbreviations(texts: DataFrame) -> DataFrame:
    """(pmid, short, long) of texts (pmid, text)."""
    return texts.select("pmid", F.explode(find_abbreviations(F.col("text"))).alias("a")).select("pmid", "a.short", "a.long")


def corpus_abbreviations(defined: DataFrame) -> DataFrame:
    """(short, long): the long form that most documents give, each spelling counted by its key; ties and the spelling that
    stands for a key go to the first document by pmid. Votes are summed before they are ranked."""
    keyed = defined.select("pmid", "short", "long", normalize_key(F.col("long")).alias("key"))
    votes = keyed.groupBy("short", "key").agg(F.count("*").alias("n"), F.min(F.struct("pmid", "long")).alias("first"))
    best = votes.groupBy("short").agg(F.min(F.struct((-F.col("n")).alias("n"), "first")).alias("b"))
    return best.select("short", F.col("b.first.long").alias("long"))


def with_long_form(mentions: DataFrame, in_document: DataFrame, in_corpus: DataFrame | None = None) -> DataFrame:
    """mentions with `long_form`: what the surface abbreviates in its own document, else in the corpus, else null. Large inputs
    are dealt before, as mentions carry their sentences and a task sorts what it joins."""
    short = F.regexp_replace("surface", r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")
    out = dealt(mentions.withColumn("_short", short), "pmid", "_short").join(in_document.select("pmid", F.col("short").alias("_short"), F.col("long").alias("_own")), ["pmid", "_short"], "left")
    if in_corpus is None:
        return out.withColumnRenamed("_own", "long_form").drop("_short")
    out = out.join(in_corpus.select(F.col("short").alias("_short"), F.col("long").alias("_all")), "_short", "left")
    return out.withColumn("long_form", F.coalesce("_own", "_all")).drop("_short", "_own", "_all")


#: Mentions of a (surface, type, long form) from which on it goes to the mentions by broadcast: at most one in so many is such a row.
FREQUENT = 50_000


def resolve_mentions(mentions: DataFrame, lexicon: DataFrame, carry: list[str]) -> DataFrame:
    """`carry` columns with entity_id, name and matched, for mentions (surface, type, long_form).

    The first candidate key that the vocabulary has decides. Otherwise the id is made of the type and the last candidate
    key (or the surface), so that equal texts still meet. Distinct (surface, type, long form) are resolved once: text in a
    corpus repeats, and a name in a third of all mentions is one row here. Frequent ones meet their mentions by broadcast, the others
    by shuffle, where mentions of frequent ones are dealt by all they hold: no task gets all mentions of a name.
    """
    what = ["surface", "type", "long_form"]
    asked = mentions.groupBy(*what).agg(F.count("*").alias("n")).withColumn("keys", candidate_keys(F.col("surface"), F.col("long_form")))
    tried = asked.select(*what, F.posexplode_outer("keys").alias("rank", "key"))
    index = lexicon_index(lexicon, tried)
    hit = tried.join(index, ["type", "key"]).groupBy(*what).agg(F.min(F.struct("rank", "entity_id", "name")).alias("hit"))
    hit = hit.select(F.col("surface").alias("_s"), F.col("type").alias("_t"), F.col("long_form").alias("_l"), "hit")
    found = asked.join(hit, (F.col("surface") == F.col("_s")) & (F.col("type") == F.col("_t")) & F.col("long_form").eqNullSafe(F.col("_l")), "left").select(*what, "n", "keys", "hit")
    last = F.coalesce(F.try_element_at("keys", F.lit(-1)), F.lower("surface"))
    known = F.col("hit").isNotNull()
    resolved = found.select(
        *(F.col(c).alias(f"_{c}") for c in what), F.when(known, F.col("hit.entity_id")).otherwise(F.concat(F.lower("type"), F.lit("-text:"), last)).alias("entity_id"),
        F.when(known, F.col("hit.name")).otherwise(F.col("surface")).alias("name"), known.alias("matched"), "n",
    )
    given = ("entity_id", "name", "matched")
    same = lambda s: (F.col("surface") == F.col(f"{s}_surface")) & (F.col("type") == F.col(f"{s}_type")) & F.col("long_form").eqNullSafe(F.col(f"{s}_long_form"))
    # The rare side's part is 0, but no literal: the planner would take it out of the join's keys.
    side = lambda df, s: df.select(*(F.col(f"_{c}").alias(f"{s}_{c}") for c in what), F.struct(*given).alias(f"{s}_found"), F.least("n", F.lit(0)).alias(f"{s}_part"))
    frequent, rare = side(resolved.where(F.col("n") >= FREQUENT), "_f"), side(resolved.where(F.col("n") < FREQUENT), "_r")
    met = mentions.join(F.broadcast(frequent), same("_f"), "left")
    parted = met.withColumn("_part", F.when(F.col("_f_found").isNull(), 0).otherwise(F.pmod(F.xxhash64(*carry), F.lit(1 << 20)).cast("int") + 1))
    joined = dealt(parted, "surface", "type", "long_form", "_part").join(rare, same("_r") & (F.col("_part") == F.col("_r_part")), "left")
    out = joined.withColumn("_found", F.coalesce("_f_found", "_r_found")).where(F.col("_found").isNotNull())
    return out.select(*carry, *(F.col(f"_found.{c}").alias(c) for c in given))


#: Characters of a bin of offsets.
BIN = 256


def contained(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """Sentences (pmid, index, start, end) with the spans (pmid, start, end, ...) that lie within them wholly; the spans'
    offsets become those in the sentence. Sentences may overlap, one whose end is before its start holds nothing.

    An equi-join by document and bin of offsets: a sentence is in each bin that it reaches into, a span in that of its start, so the two
    meet once, and a span is compared with the few sentences of its bin only. A long document's bins are dealt over tasks.
    """
    at = lambda c: F.floor(F.col(c) / BIN)
    s = outer.where(F.col("start") <= F.col("end")).select("*", F.explode(F.sequence(at("start"), at("end"))).alias("_bin")).alias("s")
    e = inner.withColumn("_bin", at("start")).alias("e")
    within = (F.col("s.pmid") == F.col("e.pmid")) & (F.col("s._bin") == F.col("e._bin")) & (F.col("e.start") >= F.col("s.start")) & (F.col("e.end") <= F.col("s.end"))
    rest = [F.col(f"e.{c}") for c in inner.columns if c not in ("pmid", "start", "end")]
    return s.join(e, within).select("s.pmid", "s.index", (F.col("e.start") - F.col("s.start")).alias("start"), (F.col("e.end") - F.col("s.start")).alias("end"), *rest)


def numbered(df: DataFrame, by: list[str], name: str = "ordinal") -> DataFrame:
    """Numbers from 0 within the whole table in an order; for small tables such as query plans."""
    return df.withColumn(name, (F.row_number().over(W.orderBy(*by)) - 1).cast("long"))
