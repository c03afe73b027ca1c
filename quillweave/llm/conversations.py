"""Conversation structure repair: a recursive query in DuckDB, inside hash-partitioned batches, advances one turn of all
conversations at a time and keeps the least cost and its audit for each state of the grammar."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillweave.llm.common import Scratch, arrow, session_of

#: Longer conversations are cut into segments of at most so many different rows, which are joined afterwards.
SEGMENT = 128
#: Rows that one recursive query takes.
BATCH = 1 << 15
#: States of the role grammar (s?(ua)+)?: nothing yet, after s, after u, after a; it may end in nothing or after a.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (EMPTY, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
#: Where a state leads with a user or assistant turn.
_TURN = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_BY_INITIAL = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "-": {}}
_WHITE = " \t\n\x0b\x0c\r"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _moves() -> pa.Table:
    """(kind, f, t, l, w, m, v): a row of that kind (its initial, or x if it must go) leads from f to t by edit l at cost w, then
    inserts m at cost v. Two inserts reach every state; more only add cost."""
    rows = []
    for kind, kept in [*_BY_INITIAL.items(), ("x", {})]:
        for f in range(4):
            edits = [(f, "D", DELETE)]
            if f in kept:
                edits.append((kept[f], "K", KEEP))
            if kind != "x":
                edits.append((_TURN[f], "R", REROLE))
            for at, letter, w in edits:
                rows += [(kind, f, at, letter, w, "", 0), (kind, f, _TURN[at], letter, w, "I", INSERT), (kind, f, _TURN[_TURN[at]], letter, w, "II", 2 * INSERT)]
    return pa.table(dict(zip(("kind", "f", "t", "l", "w", "m", "v"), map(list, zip(*rows, strict=True)), strict=True)))


#: rows (g, i, kind, cut, n): the i-th different row of group g, whether it is truncated, how many copies it stands for; the others
#: are deleted right after it, which is the cheapest and, as D comes first, the least audit. heads (g, f, st, c, a, size): states to begin with.
RECURSION = f"""
    WITH RECURSIVE s(g, size, i, f, st, c, a) AS (
        SELECT g, size, CAST(0 AS BIGINT), f, st, c, a FROM heads
        UNION ALL
        SELECT g, size, i + 1, f, t, k.c, k.a
        FROM (SELECT s.g, s.size, s.i, s.f, m.t,
                     min({{'c': s.c + m.w + m.v + {DELETE} * (r.n - 1) + CASE WHEN r.cut AND m.l <> 'D' THEN {TRUNCATED} ELSE 0 END,
                           'a': s.a || m.l || repeat('D', r.n - 1) || m.m}}) AS k
              FROM s JOIN rows r ON r.g = s.g AND r.i = s.i JOIN moves m ON m.kind = r.kind AND m.f = s.st
              GROUP BY s.g, s.size, s.i, s.f, m.t))
    SELECT g, f, st, c, a FROM s WHERE i = size ORDER BY g, f, st"""
#: Faults, illegal neighbours and turns of each group.
FACTS = """
    SELECT g, CAST(sum(CASE WHEN blank THEN n ELSE 0 END) AS BIGINT) AS blank,
           CAST(sum(CASE WHEN blank THEN 0 WHEN again THEN n ELSE n - 1 END) AS BIGINT) AS duplicate,
           CAST(sum(CASE WHEN cut AND NOT blank AND NOT again THEN 1 ELSE 0 END) AS BIGINT) AS truncated,
           CAST(sum(n - 1 + CASE WHEN before || initial NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS BIGINT) AS illegal,
           first(initial ORDER BY i) AS first, last(initial ORDER BY i) AS last,
           min(turn) AS low, max(turn) AS high, count(DISTINCT turn) AS turns
    FROM (SELECT *, lag(initial) OVER (PARTITION BY g ORDER BY i) AS before FROM rows) GROUP BY g ORDER BY g"""
_SOLVED = "key string, segment long, f int, st int, c long, a string, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
_SUMMARY = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults by crc32 of `conv_id:turn` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    `.!?` out of it, 3 repeats it, 4 makes its role user. Nulls count as one blank, but conv_id and turn stay null."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("_") == 1, "").when(F.col("_") == 2, F.regexp_replace("t", "[.!?]", "")).otherwise(F.col("t"))
    hit = conversations.select("conv_id", "turn", blank("role").alias("r"), blank("text").alias("t"), code.alias("_")).where(F.col("_") != 0)
    out = hit.select("conv_id", "turn", F.when(F.col("_") == 4, "user").otherwise(F.col("r")).alias("role"), text.alias("text"), F.when(F.col("_") == 3, 2).otherwise(1).alias("n"))
    return out.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("n"))).alias("_")).drop("_")


def _key(df: DataFrame) -> Column:
    return F.coalesce(F.concat(F.lit("="), df["conv_id"].cast("string")), F.lit("")).alias("key")


def _rows(conversations: DataFrame) -> DataFrame:
    """(key, known, turn, role, digest, text): the order of a conversation's rows is that of known, turn, role, digest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    digest = F.unhex(F.substring(F.sha2(text, 256), 1, 32))
    return conversations.select(_key(conversations), F.col("turn").isNotNull().alias("known"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), digest.alias("digest"), text.alias("text"))


def _facts(rows: DataFrame) -> DataFrame:
    """Different rows with their numbers of copies; texts are left behind."""
    last = F.right(F.rtrim("text", F.lit(_WHITE)), F.lit(1))
    facts = rows.select("key", "known", "turn", "role", "digest", (F.rtrim("text", F.lit(_WHITE)) == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    return facts.groupBy("key", "known", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("n"))


def _segments(facts: DataFrame, scratch: Scratch, segment: int) -> DataFrame:
    """Facts with `again` (role and text seen earlier) and the segment of a conversation that each is in, numbered in order.

    What repeats and which conversations are long is found by counts that are summed before they are shuffled, so neither a hot
    text nor a hot conversation meets in one task; rows of long ones are sorted by range, which deals one over many tasks."""
    once = F.min(F.struct("known", "turn")).alias("first")
    repeated = facts.groupBy("key", "role", "digest").agg(once, F.count("*").alias("times")).where(F.col("times") > 1).select("key", "role", "digest", "first")
    marked = facts.join(repeated, ["key", "role", "digest"], "left").withColumn("again", F.coalesce(~F.struct("known", "turn").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))).drop("first")
    many = facts.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > segment).select("key", F.lit(True).alias("long"))
    marked = scratch.keep(marked.join(many, "key", "left"))
    order = ["key", "known", "turn", "role", "digest"]
    short = marked.where(F.col("long").isNull()).withColumn("segment", F.lit(-1).cast("long"))
    long = marked.where(F.col("long")).repartitionByRange(*order).sortWithinPartitions(*order)
    long = scratch.keep(long.withColumn("segment", F.floor(F.monotonically_increasing_id() / segment).cast("long")))
    return short.unionByName(long).drop("long")


def _solve(facts: DataFrame) -> DataFrame:
    """Each segment's least cost and audit: of a whole conversation (segment -1) from its start, else from each state to each."""
    moves = _moves()

    def solved(table: pa.Table) -> pa.RecordBatch:
        import duckdb

        keys, segment = table.column("key").to_pylist(), table.column("segment").to_numpy()
        new = np.array([True] + [keys[i] != keys[i - 1] or segment[i] != segment[i - 1] for i in range(1, len(keys))])
        at = np.flatnonzero(new)
        g = np.cumsum(new) - 1
        initial = [r[:1] if r[:1] in _BY_INITIAL else "-" for r in table.column("role").to_pylist()]
        gone = np.logical_or(table.column("blank").to_numpy(), table.column("again").to_numpy())
        rows = pa.table({
            "g": g, "i": np.arange(len(g)) - at[g], "kind": ["x" if x else k for x, k in zip(gone, initial, strict=True)], "initial": initial,
            **{c: table.column(c).combine_chunks() for c in ("cut", "n", "blank", "again", "turn")},
        })
        size = np.diff(np.append(at, len(g)))
        begin = [(i, EMPTY, st, c, a, int(size[i])) for i in range(len(at)) if segment[at[i]] < 0 for st, c, a in ((EMPTY, 0, ""), (USER, INSERT, "I"), (ASSISTANT, 2 * INSERT, "II"))]
        begin += [(i, st, st, 0, "", int(size[i])) for i in range(len(at)) if segment[at[i]] >= 0 for st in range(4)]
        heads = pa.table({n: pa.array(v, t) for (n, t), v in zip((("g", pa.int64()), ("f", pa.int32()), ("st", pa.int32()), ("c", pa.int64()), ("a", pa.string()), ("size", pa.int64())), zip(*begin, strict=True), strict=True)})
        with duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""}) as db:
            for name, t in (("rows", rows), ("heads", heads), ("moves", moves)):
                db.register(name, t)
            best, counts = db.execute(RECURSION).fetchall(), db.execute(FACTS).fetchall()
        out = []
        for i, f, st, c, a in best:
            out.append((keys[at[i]], int(segment[at[i]]), f, st, c, a, *counts[i][1:]))
        names = ["key", "segment", "f", "st", "c", "a", *_COUNTS, "first", "last", "low", "high", "turns"]
        types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held.num_rows >= BATCH:  # all but the last segment, which may go on
                last = held.slice(held.num_rows - 1).select(["key", "segment"]).to_pylist()[0]
                i = held.num_rows - 1
                keys, segment = held.column("key"), held.column("segment")
                while i and keys[i - 1].as_py() == last["key"] and segment[i - 1].as_py() == last["segment"]:
                    i -= 1
                if i:
                    yield solved(held.slice(0, i))
                    held = held.slice(i)
        if held is not None:
            yield solved(held)

    order = ["key", "segment", "known", "turn", "role", "digest"]
    dealt = facts.select(*order, "blank", "cut", "again", F.col("n").cast("long").alias("n")).repartition("key", "segment").sortWithinPartitions(*order)
    return arrow(dealt, run, _SOLVED)


def _joined(table: pa.Table) -> pa.Table:
    """The segments of one long conversation as one, by halves: of all ways through a state between two, the cheapest, then the
    least audit. Audits of one cost and state never begin one another, so the least of each part makes the least whole."""
    segments: dict[int, list] = {}
    for r in table.to_pylist():
        one = segments.setdefault(r["segment"], [{}, r])
        one[0][r["f"], r["st"]] = (r["c"], r["a"])
    parts = [segments[k] for k in sorted(segments)]
    total = {c: sum(p[1][c] for p in parts) for c in _COUNTS}
    for (_, x), (_, y) in zip(parts, parts[1:], strict=False):
        total["illegal"] += x["last"] + y["first"] not in ("su", "ua", "au")
    known = [p[1] for p in parts if p[1]["low"] is not None]
    turns = sum(r["turns"] for r in known) - sum(x["high"] == y["low"] for x, y in zip(known, known[1:], strict=False))
    ways = [p[0] for p in parts]
    while len(ways) > 1:
        ways = [_then(*ways[i : i + 2]) if i + 1 < len(ways) else ways[i] for i in range(0, len(ways), 2)]
    start = {(EMPTY, EMPTY): (0, ""), (EMPTY, USER): (INSERT, "I"), (EMPTY, ASSISTANT): (2 * INSERT, "II")}
    cost, audit = min(v for (_, st), v in _then(start, ways[0]).items() if st in ENDS)
    gaps = known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0
    return pa.Table.from_pylist([{"key": parts[0][1]["key"], "gaps": gaps, **total, "cost": cost, "audit": audit}], pa.schema([("key", pa.string()), ("gaps", pa.int64()), *((c, pa.int64()) for c in (*_COUNTS, "cost")), ("audit", pa.string())]))


def _then(x: dict, y: dict) -> dict:
    out: dict = {}
    for (f, m), (c, a) in x.items():
        for st in range(4):
            more = y.get((m, st))
            if more is None:
                continue
            cost, best = c + more[0], out.get((f, st))
            if best is None or cost < best[0] or cost == best[0] and a + more[1] < best[1]:
                out[f, st] = (cost, a + more[1])
    return out


def _hashes(batches):
    """Rows of a conversation after its summary, in order: the summary with the SHA-256 of what the audit makes of the texts."""
    names = [f.split()[0] for f in _SUMMARY.split(", ")]
    held = digest = None
    at = state = 0
    first = True

    def say(role: str, text: str) -> None:
        nonlocal first
        digest.update(("" if first else "\n").encode() + role.encode() + b":" + text.encode())
        first = False

    def inserts() -> None:
        nonlocal at, state
        while at < len(held["audit"]) and held["audit"][at] == "I":
            state = _TURN[state]
            say(NAMES[state], "")
            at += 1

    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if not r["kind"]:
                if held is not None:
                    done.append(held | {"repaired_sha256": digest.hexdigest()})
                held, digest, at, state, first = {n: r[n] for n in names}, hashlib.sha256(), 0, EMPTY, True
                inserts()
                continue
            edit = held["audit"][at]
            at += 1
            if edit != "D":
                state = _TURN[state] if edit == "R" else _BY_INITIAL[r["role"][:1]][state]
                say(NAMES[state] if edit == "R" else r["role"], r["text"])
            inserts()
        if done:
            yield pa.RecordBatch.from_pylist(done, _HASHED)
    if held is not None:
        yield pa.RecordBatch.from_pylist([held | {"repaired_sha256": digest.hexdigest()}], _HASHED)


_HASHED = pa.schema([("key", pa.string()), ("gaps", pa.int64()), *((c, pa.int64()) for c in (*_COUNTS, "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def repair(conversations: DataFrame, ids: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations has conv_id, turn, role, text; a row's first fault of blank, duplicate, truncated counts. The audit names the edits (Keep,
    Rerole, Delete, Insert) of the cheapest way to roles of the form (s?(ua)+)?, the least of equally cheap ones.
    Rows go by turn, nulls first, then by role and the digest of the text. Null role and text count as one blank; rows without conv_id
    are one conversation; a role that starts with none of s, u, a can't be kept; equal rows are duplicates;
    conversations of `ids` without rows have zeros, an empty audit and the hash of the empty text; a table without rows gives none. Other columns
    aren't read. Rows of a long conversation are dealt over tasks; its audit, a letter a row, and its hash are one value, so one task at the end
    reads its texts in order, a batch at a time.
    """
    scratch = Scratch(session_of(conversations), "conversations")
    rows = _rows(conversations)
    facts = scratch.keep(_facts(rows))
    solved = scratch.keep(_solve(_segments(facts, scratch, segment)))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
    least = F.min(F.struct(F.col("c").alias("cost"), F.col("a").alias("audit"))).alias("k")
    whole = solved.where((F.col("segment") < 0) & F.col("st").isin(*ENDS)).groupBy("key", gaps.alias("gaps"), *_COUNTS).agg(least).select("key", "gaps", *_COUNTS, "k.*")
    long = solved.where(F.col("segment") >= 0).groupBy("key").applyInArrow(_joined, _SUMMARY)
    ids = (conversations if ids is None else ids).select("conv_id").distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *_COUNTS, "cost")]
    summary = ids.select("conv_id", _key(ids)).join(whole.unionByName(long), "key", "left").select("key", *zero, F.coalesce("audit", F.lit("")).alias("audit"))
    null = lambda t, c: F.lit(None).cast(t).alias(c)
    order = ["key", "kind", "known", "turn", "role", "digest"]
    head = summary.select("key", F.lit(0).alias("kind"), null("boolean", "known"), null("long", "turn"), null("string", "role"), null("binary", "digest"), null("string", "text"), "gaps", *_COUNTS, "cost", "audit")
    body = rows.select("key", F.lit(1).alias("kind"), "known", "turn", "role", "digest", "text", *(null("long", c) for c in ("gaps", *_COUNTS, "cost")), null("string", "audit"))
    stream = head.unionByName(body).repartition("key").sortWithinPartitions(*order)
    found = arrow(stream.drop("known", "digest"), _hashes, _SUMMARY + ", repaired_sha256 string")
    conv_id = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(conversations.schema["conv_id"].dataType).alias("conv_id")
    return found.select(conv_id, "gaps", *_COUNTS, "cost", "audit", "repaired_sha256")


def oracle() -> str:
    """SQL for repair(damage(conversations)) with every conversation, a row at a time and with the repaired text carried along."""
    bits = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(id, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: xor(c >> 8, {bits.replace('xor(c, b)', 'xor(c, b) & 255')})), 4294967295)"
    return rf"""
        WITH RECURSIVE source AS (
               SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
             coded AS (SELECT *, {crc} % 20 AS code FROM source),
             damaged AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
                                CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
                         FROM coded, range(CASE WHEN code = 0 THEN 0 WHEN code = 3 THEN 2 ELSE 1 END) copies(n)),
             placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged),
             judged AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                               NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, substr(role, 1, 1) AS initial,
                               lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
                        FROM placed),
             counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                                count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
                                count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
                                count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS size
                         FROM judged GROUP BY conv_id),
             turns(f, t, name) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (3, 2, 'user'), (2, 3, 'assistant')),
             kept(initial, f, t) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
             inserts AS (SELECT f, f AS t, '' AS m, '' AS said FROM (VALUES (0), (1), (2), (3)) states(f)
                         UNION ALL SELECT f, t, 'I', chr(10) || name || ':' FROM turns
                         UNION ALL SELECT x.f, y.t, 'II', chr(10) || x.name || ':' || chr(10) || y.name || ':' FROM turns x JOIN turns y ON y.f = x.t),
             edits AS (SELECT conv_id, i, f, f AS t, 'D' AS l, 4 AS w, '' AS said FROM judged, (VALUES (0), (1), (2), (3)) states(f)
                       UNION ALL SELECT conv_id, i, f, t, 'K', CASE WHEN cut THEN 3 ELSE 0 END, chr(10) || role || ':' || text
                       FROM judged JOIN kept USING (initial) WHERE NOT blank AND NOT again
                       UNION ALL SELECT conv_id, i, f, t, 'R', CASE WHEN cut THEN 6 ELSE 3 END, chr(10) || name || ':' || text
                       FROM judged, turns WHERE NOT blank AND NOT again),
             steps AS (SELECT e.conv_id, e.i, e.f, n.t, e.l || n.m AS l, e.w + 3 * length(n.m) AS w, e.said || n.said AS said FROM edits e JOIN inserts n ON n.f = e.t),
             best AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, t AS st, {{'c': CAST(3 * length(m) AS BIGINT), 'a': m, 'x': said}} AS k FROM counted, inserts WHERE f = 0
                      UNION ALL
                      SELECT conv_id, i, t, min(k) FROM (
                          SELECT b.conv_id, s.i, s.t, {{'c': CAST(b.k.c + s.w AS BIGINT), 'a': b.k.a || s.l, 'x': b.k.x || s.said}} AS k
                          FROM best b JOIN steps s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i + 1 AND s.f = b.st)
                      GROUP BY conv_id, i, t),
             repaired AS (SELECT c.conv_id, min(b.k) AS k FROM counted c JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.size
                          WHERE b.st IN (0, 3) GROUP BY c.conv_id)
        SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
               coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(r.k.c, 0) AS cost, coalesce(r.k.a, '') AS audit,
               sha256(coalesce(substr(r.k.x, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id"""
