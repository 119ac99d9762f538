"""Repair of conversations: cheapest edits to a grammar of roles, by Dijkstra's search.

The lattice of (turn index, grammar state) is implicit: its edges are made as nodes are taken from the heap, whose key
is (cost, audit), the audit being the edits' initials so far.  The first accepting end node taken is the answer.  Equal
audits have equal costs, so among equal costs at a node no audit begins another, and the least audit so far stays the
least whatever follows.

Spark deals damaged rows to ranges of (conversation, turn), so that no conversation, however long, has to be in one
task.  A conversation that lies within a task's range and has at most BLOCK rows is repaired there.  The first and
the last of each range and longer ones are cut into blocks of BLOCK rows by their place; the same search gives for each
block the cheapest way from every state to every state, and runs again over FAN blocks as edges until one is left.
Their repaired lines are hashed as a sorted stream, which holds one line at a time.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

BLOCK, FAN = 256, 32
BLOCK_BYTES = 4 << 20  # of text that a task keeps for a conversation
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Grammar `(s?(ua)+)?`: states 0 nothing yet, 1 after s, 2 after u, 3 after a; the turn that must follow each.
FOLLOW = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
ACCEPTING = (0, 3)
STATES = range(4)
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}

SPACE = "\t\n\x0b\x0c\r "
FINE, BLANK, DUPLICATE, CUT = range(4)


# ---------------------------------------------------------------- the search


def cheapest(entry: int, end: int, edges, accepting=None) -> dict[int, tuple[int, str]]:
    """For each state, the least (cost, audit) from `entry` at 0 to it at `end`; with accepting, only the first of those."""
    heap, done, found = [(0, "", 0, entry)], set(), {}
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == end:
            if accepting is None:
                found[state] = (cost, audit)
            elif state in accepting:
                return {state: (cost, audit)}
        for j, to, more, edit in edges(i, state):
            if (j, to) not in done:
                heapq.heappush(heap, (cost + more, audit + edit, j, to))
    return found


def row_edges(rows):
    """Edges over rows of (role's initial, fault)."""

    def edges(i: int, state: int):
        letter, to = FOLLOW[state]
        if i < len(rows):
            initial, fault = rows[i]
            yield i + 1, state, DELETE, "D"
            if fault in (FINE, CUT):
                more = TRUNCATED if fault == CUT else 0
                if initial == letter:
                    yield i + 1, to, KEEP + more, "K"
                else:
                    yield i + 1, to, REROLE + more, "R"
                    if state == 0 and initial == "s":
                        yield i + 1, 1, KEEP + more, "K"
        yield i, to, INSERT, "I"

    return edges


@lru_cache(1 << 15)
def repair(rows: tuple) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows of (role's initial, fault)."""
    return next(iter(cheapest(0, len(rows), row_edges(rows), ACCEPTING).values()))


def passage(rows) -> list:
    """For a block, from each state to each: (cost, audit), or None."""
    return [[found.get(t) for t in STATES] for found in (cheapest(s, len(rows), row_edges(rows)) for s in STATES)]


def joined(passages: list) -> list:
    """The passage through several blocks in order, by the same search with blocks as edges."""

    def edges(i: int, state: int):
        if i < len(passages):
            for to, way in enumerate(passages[i][state]):
                if way:
                    yield i + 1, to, *way

    return [[found.get(t) for t in STATES] for found in (cheapest(s, len(passages), edges) for s in STATES)]


def edited(audit: str, heads):
    """For each row the lines put before it and who speaks (None: deleted, "": as it was); then what is put at the end, and None.

    heads: whether a row begins with s; asked only of the first row kept.
    """
    held, state, row = [], 0, 0
    for edit in audit:
        letter, to = FOLLOW[state]
        if edit == "I":
            held.append(f"{NAMES[letter]}:")
            state = to
            continue
        yield "\n".join(held), None if edit == "D" else "" if edit == "K" else NAMES[letter]
        held = []
        if edit != "D":
            state = 1 if edit == "K" and state == 0 and heads(row) else to
        row += 1
    yield "\n".join(held), None


# ---------------------------------------------------------------- rows


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: damage by crc32 of `conv_id:turn`; dropped rows stay as gone, for their conv_id."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(one("text"), "[.!?]", "")).otherwise(one("text"))
    x = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(one("role")).alias("role"), text.alias("text"), (kind == 0).alias("gone"), F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return x.select("conv_id", "turn", "role", "text", "gone", F.explode("copies").alias("copy")).drop("copy")


def whole(rows: DataFrame) -> DataFrame:
    """The same without damage."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), one("role").alias("role"), one("text").alias("text"), F.lit(False).alias("gone"))





def fault_of(text: str, seen: bool) -> int:
    tail = text.rstrip(SPACE)
    return BLANK if not tail else DUPLICATE if seen else FINE if tail[-1] in ".!?" else CUT


DONE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
OPEN = "turn long, role string, text string, digest binary, gone boolean, part long, i long"
COUNTS = ("blank", "duplicate", "truncated", "illegal")
MOST = 2**63 - 1


def measured(conv, rows: list) -> tuple:
    """The result of a conversation that is at hand as rows (turn, role, text, digest)."""
    seen, faults = set(), []
    for _, _, text, digest in rows:
        faults.append(fault_of(text, digest in seen))
        seen.add(digest)
    initials = [r[1][:1] for r in rows]
    cost, audit = repair(tuple(zip(initials, faults, strict=True)))
    lines = []
    for (put, who), (_, role, text, _) in zip(edited(audit, lambda i: initials[i] == "s"), [*rows, (None,) * 4], strict=True):
        lines += [put] if put else []
        lines += [] if who is None else [f"{who or role}:{text}"]
    turns = [t for t, *_ in rows if t is not None]
    gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), MOST) if turns else 0
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit, sha


def first_pass(batches, block: int, block_bytes: int):
    """Results of conversations inside a range of sorted rows; rows of the first, the last and the long ones, numbered, as open."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema([(n, pa.string() if t == "string" else pa.binary() if t == "binary" else pa.bool_() if t == "boolean" else pa.int64()) for n, t in (x.split() for x in f"{DONE}, {OPEN}".split(", "))])
    out: dict[str, list] = {n: [] for n in schema.names}
    now, held, size, at, is_open, began = None, [], 0, 0, True, False

    def emit(**values):
        for n in schema.names:
            out[n].append(values.get(n))

    def let_go():
        nonlocal at, held, size
        for turn, role, text, digest, gone in held:
            emit(conv_id=now, turn=turn, role=role, text=text, digest=digest, gone=gone, part=part, i=at)
            at += not gone
        held, size = [], 0

    def full():
        batch = pa.RecordBatch.from_pydict(out, schema=schema)
        for x in out.values():
            x.clear()
        return batch

    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            cut = batch.slice(lo, 1024)
            for conv, turn, role, text, digest, gone in zip(*(cut.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "digest", "gone")), strict=True):
                if began and conv != now:
                    if is_open:
                        let_go()
                    else:
                        emit(**dict(zip((x.split()[0] for x in DONE.split(", ")), measured(now, [r[:4] for r in held if not r[4]]), strict=True)), part=part)
                    held, size, at, is_open = [], 0, 0, False
                now, began = conv, True
                held.append((turn, role, text, digest, gone))
                size += len(text) + len(role)
                if len(held) > block or size > block_bytes:
                    is_open = True
                if is_open:
                    let_go()
            yield full()
    if began:
        let_go()  # the last may go on in the next range
        yield full()


# ---------------------------------------------------------------- conversations that several tasks see

PASSAGE = "k string, block long, first string, last string, blank long, duplicate long, truncated long, illegal long, costs array<long>, audits array<string>"


def passage_table(k: str, block: int, first: str, last: str, counts: dict, ways: list) -> pa.Table:
    flat = [w for row in ways for w in row]
    row = {"k": k, "block": block, "first": first, "last": last, **counts, "costs": [w[0] if w else None for w in flat], "audits": [w[1] if w else None for w in flat]}
    kinds = {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string()), **{c: pa.int64() for c in (*COUNTS, "block")}}
    return pa.table({n: pa.array([v], kinds.get(n, pa.string())) for n, v in row.items()})


def block_passage(key, table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    initials, faults = table["initial"].to_pylist(), table["fault"].to_pylist()
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    counts = dict(zip(COUNTS, (faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal), strict=True))
    return passage_table(key[0].as_py(), key[1].as_py(), initials[0], initials[-1], counts, passage(tuple(zip(initials, faults, strict=True))))


def joined_passage(key, table: pa.Table) -> pa.Table:
    rows = table.sort_by("block").to_pylist()
    ways = [[[None if c is None else (c, a) for c, a in zip(r["costs"][4 * s : 4 * s + 4], r["audits"][4 * s : 4 * s + 4], strict=True)] for s in STATES] for r in rows]
    counts = {c: sum(r[c] for r in rows) for c in COUNTS}
    counts["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
    return passage_table(key[0].as_py(), key[1].as_py(), rows[0]["first"], rows[-1]["last"], counts, joined(ways))


def edits(batches):
    """k, pos, before, given for each row of each audit, and a last row for what is put at the end; k, audit, head come in."""
    for batch in batches:
        for k, audit, head in zip(*(batch.column(c).to_pylist() for c in ("k", "audit", "head")), strict=True):
            rows = enumerate(edited(audit, lambda _, head=head: head == "s"))
            while part := list(islice(rows, 1 << 14)):
                yield pa.RecordBatch.from_pydict({"k": [k] * len(part), "pos": pa.array([i for i, _ in part], pa.int64()), "before": [x for _, (x, _) in part], "given": pa.array([x for _, (_, x) in part], pa.string())})


def hashed(batches):
    """k, repaired_sha256 of rows sorted by k, pos: lines are hashed as they come."""
    now, h, any_line, out = None, None, False, []
    for batch in batches:
        for k, *lines in zip(*(batch.column(c).to_pylist() for c in ("k", "before", "line")), strict=True):
            if k != now:
                if h is not None:
                    out.append((now, h.hexdigest()))
                now, h, any_line = k, hashlib.sha256(), False
            for line in lines:
                if line:
                    h.update((b"\n" if any_line else b"") + line.encode())
                    any_line = True
        if out:
            yield pa.RecordBatch.from_pydict({"k": [x for x, _ in out], "repaired_sha256": [x for _, x in out]})
            out = []
    if h is not None:
        yield pa.RecordBatch.from_pydict({"k": [now], "repaired_sha256": [h.hexdigest()]})


def far_repair(rows: DataFrame, block: int) -> DataFrame:
    """Results, as of DONE, from open rows: numbered rows of ranges, of conversations in several tasks or of many rows."""
    k = F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("k")
    every = rows.select(k, "turn", "role", "text", "digest", "gone", "part", "i")
    live = every.where("not gone")
    runs = live.groupBy("k", "part").agg(F.count("*").alias("n"))
    before = runs.withColumn("offset", F.sum("n").over(Window.partitionBy("k").orderBy("part")) - F.col("n")).drop("n")  # a row a task at most
    tail = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    numbered = live.join(before, ["k", "part"]).select("k", (F.col("offset") + F.col("i")).alias("pos"), "turn", "role", "text", "digest", F.substring("role", 1, 1).alias("initial"), tail.alias("tail"))
    numbered = C.save(numbered, "open-turns")
    firsts = numbered.groupBy("k", "digest").agg(F.min("pos").alias("pos")).select("k", "pos", F.lit(True).alias("new"))
    fault = F.when(F.col("tail") == "", BLANK).when(F.col("new").isNull(), DUPLICATE).when(F.col("tail").isin(".", "!", "?"), FINE).otherwise(CUT)
    marked = numbered.select("k", "pos", "initial", "tail").join(firsts, ["k", "pos"], "left").select("k", "pos", "initial", fault.alias("fault"), F.expr(f"pos div {block}").alias("block"))
    ways = C.save(marked.groupBy("k", "block").applyInArrow(lambda key, t: block_passage(key, t), PASSAGE), "passages")
    top = ways.agg(F.max("block")).first()[0] or 0
    while top:
        top //= FAN
        ways = C.save(ways.withColumn("up", F.expr(f"block div {FAN}")).groupBy("k", "up").applyInArrow(lambda key, t: joined_passage(key, t), PASSAGE), "passages")
    ends = F.array_min(F.array(*(F.when(F.get("costs", F.lit(s)).isNotNull(), F.struct(F.get("costs", F.lit(s)).alias("cost"), F.get("audits", F.lit(s)).alias("audit"))) for s in ACCEPTING)))
    best = C.save(ways.withColumn("x", ends).select("k", *COUNTS, "x.cost", "x.audit"), "audits")
    # the grammar's s can only be the first turn kept, and only a kept turn has an initial of its own
    heads = best.select("k", F.length(F.regexp_extract("audit", "^D*", 0)).cast("long").alias("pos")).join(numbered.select("k", "pos", "initial"), ["k", "pos"]).select("k", F.col("initial").alias("head"))
    told = best.select("k", "audit").join(heads, "k", "left").mapInArrow(edits, "k string, pos long, before string, given string")
    own = F.when(F.col("given") == "", F.col("role")).otherwise(F.col("given"))
    lines = told.join(numbered.select("k", "pos", "role", "text"), ["k", "pos"], "left").select("k", "pos", "before", F.concat(own, F.lit(":"), F.col("text")).alias("line"))
    sha = lines.repartition("k").sortWithinPartitions("k", "pos").mapInArrow(hashed, "k string, repaired_sha256 string")
    turns = numbered.where("turn is not null").groupBy("k", "turn").agg(F.lit(1).alias("one")).groupBy("k").agg(F.max("turn").alias("z"), F.min("turn").alias("a"), F.count("*").alias("n"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    gaps = turns.select("k", F.least(wide("z") - wide("a") + 1 - F.col("n"), F.lit(MOST)).cast("long").alias("gaps"))
    out = every.select("k").distinct().join(best, "k", "left").join(sha, "k", "left").join(gaps, "k", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.when(F.col("k") != "null", F.col("k").cast("long")).alias("conv_id"), zero("gaps"), *(zero(c) for c in COUNTS), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def repaired(rows: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row for each conv_id.

    rows: conv_id, turn, role, text, gone, as from `damaged` or `whole`.  Turns are taken in order, null ones first; rows
    of one turn in the order of a hash of role and text, so that equal ones are neighbours.  Rows of a null conv_id are
    one conversation; a null role or text is one space; an empty role fits no place of the grammar.  One without rows that aren't gone has zeros, an empty audit and
    the hash of nothing.  Gaps beyond a long are the largest long.  An empty table gives none.
    """
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    x = rows.select("conv_id", "turn", "role", "text", digest.alias("digest"), "gone", F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("digest"), F.asc("salt")]  # the salt deals out equal rows
    x = x.repartitionByRange(*order).sortWithinPartitions(*order)
    seen = C.save(x.mapInArrow(lambda b: first_pass(b, block, block_bytes), f"{DONE}, {OPEN}"), "turns")
    names = [c.split()[0] for c in DONE.split(", ")]
    near = seen.where("repaired_sha256 is not null").select(*names)
    return near.unionByName(far_repair(seen.where("repaired_sha256 is null"), block))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _way(key: str, cost, edit: str) -> str:
    """SQL of a key of nine digits of cost and the audit, extended by an edit."""
    return f"lpad((({key})[1:9]::BIGINT + {cost})::VARCHAR, 9, '0') || ({key})[10:] || '{edit}'"


def _turn(key: str, letter: str) -> str:
    more = "CASE WHEN f = 3 THEN 5 ELSE 0 END"
    return f"CASE WHEN f IN (0, 3) THEN CASE WHEN ini = '{letter}' THEN {_way(key, more, 'K')} ELSE {_way(key, f'1 + {more}', 'R')} END END"


_U = f"least(d2, t0, t1, t3, {_way('n0', 5, 'I')}, {_way('n1', 5, 'I')}, {_way('n3', 5, 'I')})"
# every row moves four keys on; the least string is the least cost, then the least audit
SQL = f"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
  k AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
  c AS (SELECT k.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda s: ascii(s)::BIGINT)), lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS kind FROM k, crc),
  w AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
    FROM c, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) r(copy)),
  o AS (SELECT *, role[1] AS ini, row_number() OVER q AS i FROM w WINDOW q AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text))),
  f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ \\t\\n\\x0B\\f\\r]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN regexp_matches(text, '[.!?][ \\t\\n\\x0B\\f\\r]*$') THEN 0 ELSE 3 END AS f, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM o),
  m AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated, count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
  z AS (SELECT conv_id, 0::BIGINT AS i, '000000000' AS k0, NULL::VARCHAR AS k1, '000000005I' AS k2, '000000010II' AS k3 FROM m UNION ALL
    SELECT conv_id, i, n0, n1, u, least(n3, {_way('u', 5, 'I')}) FROM (SELECT *, {_U} AS u FROM (SELECT *, d0 AS n0, least(d1, CASE WHEN f IN (0, 3) AND ini = 's' THEN {_way('k0', 'CASE WHEN f = 3 THEN 5 ELSE 0 END', 'K')} END) AS n1, least(d3, t2) AS n3
      FROM (SELECT f.conv_id, f.i, f.ini, f.f, k0, {', '.join(f"{_way(f'k{s}', 2, 'D')} AS d{s}, {_turn(f'k{s}', 'a' if s == 2 else 'u')} AS t{s}" for s in range(4))} FROM z JOIN f ON f.conv_id IS NOT DISTINCT FROM z.conv_id AND f.i = z.i + 1)))),
  b AS (SELECT m.*, least(k0, k3)[1:9]::BIGINT AS cost, least(k0, k3)[10:] AS audit FROM m JOIN z ON z.conv_id IS NOT DISTINCT FROM m.conv_id AND z.i = m.n),
  e AS (SELECT conv_id, j, audit[j] AS e, count(*) FILTER (audit[j] <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i, count(*) FILTER (audit[j] <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS said FROM b, range(1, length(audit) + 1) r(j)),
  l AS (SELECT e.conv_id, j, e, said, role, text, max(e = 'K' AND said = 1 AND ini = 's') OVER (PARTITION BY e.conv_id) AS head FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND e.e <> 'I' WHERE e <> 'D'),
  h AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (said - head::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j)) AS sha FROM l GROUP BY conv_id)
  SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM a.conv_id"""
