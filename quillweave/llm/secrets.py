"""Secret scans in DataFrame functions only, with corpus-wide ownership frequency of what they find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillweave.llm.common import Scratch, fresh, session_of

#: The kinds in their order, each with its pattern and the least length of its value.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]{12,}"),
    ("hex", r"[0-9a-f]{32,}"),
)
ASSIGN_VALUE = 8
#: The method's own candidates: unbroken runs of key characters, with digits and both cases and many different letters.
BLOB = ("blob", r"[A-Za-z0-9+/_-]{20,}")
BLOB_MOST, BLOB_DISTINCT = 256, 12
#: A value that more owners or more documents than this have is a widely copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 20
MARK = "\x01"
STEP = 256

SPAN = "struct<start:bigint,no:int,kind:string,end:bigint,value:bigint>"


def _starts(lengths: Column) -> Column:
    """Running sums before each element. Done in steps of STEP elements, so that no list is copied once per element."""
    at = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STEP).cast("int"))
    part = lambda i: F.slice(lengths, i * STEP + 1, STEP)
    grow = lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    empty = lambda base: F.struct(base.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
    sums = F.transform(at, lambda i: F.aggregate(part(i), F.lit(0).cast("bigint"), lambda a, n: a + n))
    bases = F.aggregate(sums, empty(F.lit(0)), grow)["out"]
    return F.flatten(F.transform(at, lambda i: F.aggregate(part(i), empty(F.element_at(bases, i + 1)), grow)["out"]))


def matches(text: Column, kind: str, no: int, pattern: str) -> Column:
    """Array of spans (code points, end exclusive) of a pattern's leftmost non-overlapping matches, with their texts.

    The matches are fenced by a mark, the text split at it: every second piece is a match. The mark stands for no
    character of any pattern; where the text holds it, another such character replaces it, which moves no match.
    """
    pieces = F.split(F.regexp_replace(F.translate(text, MARK, "\x02"), pattern, f"{MARK}$0{MARK}"), MARK)
    lengths = F.transform(pieces, lambda p: F.length(p).cast("bigint"))
    zipped = F.arrays_zip(pieces.alias("text"), _starts(lengths).alias("start"))
    zipped = zipped.cast("array<struct<text:string,start:bigint>>")
    odd = F.filter(zipped, lambda _, i: i % 2 == 1)
    return F.when(F.size(pieces) > 1, F.transform(odd, lambda p: F.struct(p["start"].alias("start"), F.lit(no).alias("no"), F.lit(kind).alias("kind"), (p["start"] + F.length(p["text"])).alias("end"), p["text"].alias("text")))).otherwise(F.array().cast("array<struct<start:bigint,no:int,kind:string,end:bigint,text:string>>"))


def _hashed(spans: Column, value) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["no"], s["kind"], s["end"], F.xxhash64(value(s["text"])).alias("value"))).cast(f"array<{SPAN}>")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """Per row: doc_id, owner, key (of id, text and owner), base and blob spans, their values as hashes."""
    text = F.col("text")
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    (assign, assign_re), *rest = KINDS
    value = lambda t: F.regexp_extract(t, assign_re, 2)
    found = F.filter(matches(text, assign, 0, assign_re), lambda s: F.length(value(s["text"])) >= ASSIGN_VALUE)
    base = F.concat(_hashed(found, value), *(_hashed(matches(text, k, i + 1, p), lambda t: t) for i, (k, p) in enumerate(rest)))
    kind, pattern = BLOB
    blob = F.filter(matches(text, kind, len(KINDS), pattern), lambda s: (F.length(s["text"]) <= BLOB_MOST) & s["text"].rlike("[0-9]") & s["text"].rlike("[a-z]") & s["text"].rlike("[A-Z]") & (F.size(F.array_distinct(F.split(s["text"], ""))) >= BLOB_DISTINCT))
    key = F.struct(F.xxhash64("doc_id", "owner", "text").alias("a"), F.hash("text", "doc_id").alias("b"))
    return df.select("doc_id", "owner", key.alias("key"), F.array_sort(base).alias("base"), _hashed(blob, lambda t: t).alias("blob"))


def ownership(found: DataFrame) -> DataFrame:
    """value -> n_repositories, n_owners: distinct documents and owners that hold it. Sums are taken before each
    shuffle, so a value in a third of all rows costs one row per task."""
    one = found.select("doc_id", "owner", F.explode(F.array_distinct(F.transform(F.concat("base", "blob"), lambda s: s["value"]))).alias("value"))
    per_owner = one.groupBy("value", "owner", "doc_id").agg(F.lit(1).alias("n")).groupBy("value", "owner").agg(F.sum("n").alias("n"))
    return per_owner.groupBy("value").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per row of docs: doc_id, key, base (spans), added (spans of the method), live (values' spans that are
    owner-specific), n_live and n_example.

    Base spans: the three kinds of KINDS; those of a value that at most max_owners owners and max_repositories documents hold
    count as live, others as widely copied examples (also where one owner alone has copied it). Added spans: live blobs that no base span overlaps. A null text is empty, a null owner is an
    owner of its own, a null id a repository of its own; repeated rows give repeated results and count once as a repository.
    """
    scratch = Scratch(session_of(docs), "secrets")
    found = scratch.keep(candidates(docs, id_col, text_col, owner_col))
    owners = ownership(found).where((F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)).select("value")
    each = found.where(F.size(F.concat("base", "blob")) > 0).select("key", F.explode(F.concat("base", "blob")).alias("s")).select("key", F.col("s.value").alias("value")).distinct()
    live = each.join(owners, "value", "left_semi").groupBy("key").agg(F.collect_set("value").alias("live"))
    joined = found.join(live, "key", "left").withColumn("live", F.coalesce("live", F.array().cast("array<bigint>")))
    is_live = lambda s: F.array_contains(F.col("live"), s["value"])
    clear = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    joined = joined.withColumn("added", F.filter("blob", lambda s: is_live(s) & clear(s)))
    every = F.array_sort(F.concat("base", "added"))
    return joined.select("doc_id", "key", "base", "added", every.alias("spans"), F.filter(every, is_live).alias("live")).withColumns({"n_live": F.size("live").cast("long"), "n_example": (F.size("spans") - F.size("live")).cast("long")})


def digest(scanned: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select("doc_id", *(count(k) for k, _ in KINDS), F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"), "n_live", "n_example")


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", placeholder: str = "<SECRET>") -> DataFrame:
    """docs with every live span of their texts replaced by the placeholder; widely copied examples stay. A null text
    stays null; overlapping spans are masked as one."""
    key_, live_ = fresh(docs, "key", "live")
    scanned = scan(docs, id_col, text_col, owner_col).where(F.size("live") > 0).groupBy("key").agg(F.first("live").alias(live_)).withColumnRenamed("key", key_)
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.struct(F.xxhash64(F.col(id_col), F.col(owner_col).cast("string"), whole).alias("a"), F.hash(whole, F.col(id_col)).alias("b"))
    joined = docs.withColumn(key_, key).join(scanned, key_, "left")
    text = F.col(text_col)
    piece = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(placeholder)))).otherwise(acc["out"]).alias("out"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    masked = F.aggregate(live_, start, piece, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return joined.withColumn(text_col, F.when(F.col(live_).isNotNull(), masked).otherwise(text)).select(*docs.columns)


def oracle() -> str:
    """The same rows in SQL, for texts whose letters are cased in ASCII."""
    quote = lambda p: p.replace("'", "''")
    kinds = [*KINDS, BLOB]
    cut = " UNION ALL ".join(f"SELECT doc_id, source, t, '{k}' AS kind, {i} AS no, string_split(regexp_replace(t, '{quote(p)}', chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts FROM d" for i, (k, p) in enumerate(kinds))
    return f"""
        WITH d AS (SELECT doc_id, source, translate(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
             p AS ({cut}),
             m AS (SELECT doc_id, source, kind, no, parts, unnest(range(2, len(parts) + 1, 2)) AS i FROM p),
             s AS (SELECT doc_id, source, kind, no, parts[i] AS piece,
                          CAST(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))) AS BIGINT) AS start FROM m),
             v AS (SELECT *, start + length(piece) AS stop,
                          CASE kind WHEN 'assign' THEN regexp_extract(piece, '{quote(KINDS[0][1])}', 2) ELSE piece END AS value FROM s),
             w AS (SELECT * FROM v WHERE CASE kind WHEN 'assign' THEN length(value) >= {ASSIGN_VALUE}
                       WHEN 'blob' THEN length(value) <= {BLOB_MOST} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]')
                            AND regexp_matches(value, '[A-Z]') AND len(list_distinct(string_split(value, ''))) >= {BLOB_DISTINCT}
                       ELSE true END),
             o AS (SELECT value, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repositories FROM w GROUP BY value),
             x AS (SELECT w.*, owners <= {MAX_OWNERS} AND repositories <= {MAX_REPOSITORIES} AS live FROM w JOIN o USING (value)),
             y AS (SELECT * FROM x WHERE kind <> 'blob' OR live AND NOT EXISTS (
                       SELECT 1 FROM x b WHERE b.doc_id = x.doc_id AND b.kind <> 'blob' AND b.start < x.stop AND x.start < b.stop)),
             g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                          count(*) FILTER (kind = 'hex') AS n_hex,
                          string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) FILTER (kind <> 'blob') AS base,
                          string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) AS spans,
                          count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM y GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
               coalesce(n_example, 0) AS n_example FROM d LEFT JOIN g USING (doc_id)"""
