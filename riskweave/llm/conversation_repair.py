"""Operator 11: the cheapest repair of conversations, by Dial's bucket queue.

A conversation may start with a system turn and then alternates user and
assistant turns, ending with the assistant's. Its repair is a shortest path
through pairs of a row and a state: keeping a row is free, giving it another
role costs 2, deleting it 3, inserting an empty turn 2, and a truncated row that
stays costs 1 more; blank rows and duplicates have to go. Costs are small
integers, so distances to the end come from a circular queue of buckets without
any heap. Then a walk from the start takes, of the arcs that lie on a shortest
path, the one whose initial (D, I, K, R) is least; its letters are the audit.

A conversation of at most BLOCK_ROWS rows is repaired where it has been sorted.
The rows of a longer one are sorted by range over many tasks and cut into blocks
of that many rows: each block gives the costs between all its states, these are
composed backwards (one row a block) to the distances at each block's end, every
block walks from all four states, and the states that the walks meet are
composed forwards. Only what is sequential by nature passes through one task,
streaming: the digest of all lines of a conversation, and its audit.

Results by case: null roles and texts are one space; a null conv_id is a
conversation of its own; null turns come first and make no gap; rows with equal
turns are ordered by role, then by the hash of their text, then by the text; a
role without characters can't be kept; a conversation without rows has no edits
and the digest of the empty text. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import broadcast_below, cut

#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: States: nothing yet, after the system turn, the assistant is due, complete.
STATES, START, ENDS = 4, 0, (0, 3)
DUE = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FAR = 1 << 60
#: Whether a state's distance at the end of a conversation is 0.
GOALS = tuple(0 if s in ENDS else FAR for s in range(STATES))
OK, BLANK, DUPLICATE, CUT_SHORT = range(4)
SPACES, STOPS = " \t\n\r\x0b\x0c", ".!?"
LEGAL = ("su", "ua", "au")
BLOCK_ROWS = 4096

_FROM_KEEP = [{} for _ in range(STATES)]  # state after -> initial -> states before
for _before, _moves in enumerate(KEPT):
    for _initial, _after in _moves.items():
        _FROM_KEEP[_after].setdefault(_initial, []).append(_before)
_FROM_DUE = [[s for s in range(STATES) if DUE[s][1] == after] for after in range(STATES)]


def distances(initials: list[str], faults: list[int], goals: tuple[int, ...] = GOALS) -> list[int]:
    """The least cost from each (row, state), at 4 * row + state, to the end, whose states cost ``goals``."""
    n = len(initials)
    reach = [FAR] * (STATES * (n + 1))
    near = [g for g in goals if g < FAR]
    low, span = min(near), max(DELETE, REROLE + TRUNCATED, max(near) - min(near)) + 1
    buckets: list[list[int]] = [[] for _ in range(span)]
    waiting = 0
    for state, goal in enumerate(goals):
        if goal < FAR:
            reach[STATES * n + state] = goal
            buckets[goal % span].append(STATES * n + state)
            waiting += 1
    at = low
    while waiting:
        bucket = buckets[at % span]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if reach[node] != at:
                continue
            row, state = divmod(node, STATES)
            before = [(STATES * row + s, INSERT) for s in _FROM_DUE[state]]
            if row:
                base, fault = STATES * (row - 1), faults[row - 1]
                before.append((base + state, DELETE))
                if fault not in (BLANK, DUPLICATE):
                    more = TRUNCATED if fault == CUT_SHORT else 0
                    before += [(base + s, more) for s in _FROM_KEEP[state].get(initials[row - 1], ())]
                    before += [(base + s, REROLE + more) for s in _FROM_DUE[state]]
            for other, cost in before:
                if at + cost < reach[other]:
                    reach[other] = at + cost
                    buckets[(at + cost) % span].append(other)
                    waiting += 1
        at += 1
    return reach


def walk(initials: list[str], faults: list[int], reach: list[int], goals: tuple[int, ...] = GOALS, state: int = START) -> tuple[list[str], int]:
    """The edits of each row on the least of the shortest paths, and the state at the end.

    Letters of a row: u, a for turns inserted before it, then D or K, or U, A for
    its new role; what the end inserts follows the last row's, or stands alone.
    """
    codes, row, n = [""], 0, len(initials)
    while True:
        left = reach[STATES * row + state]
        if row == n and left == goals[state]:
            break
        role, due = DUE[state]
        if row < n:
            forced, more = faults[row] in (BLANK, DUPLICATE), TRUNCATED if faults[row] == CUT_SHORT else 0
            after = STATES * (row + 1)
            keep = None if forced else KEPT[state].get(initials[row])
            if reach[after + state] + DELETE == left:
                edit, state = "D", state
            elif reach[STATES * row + due] + INSERT == left:
                codes[-1] += role[0]
                state = due
                continue
            elif keep is not None and reach[after + keep] + more == left:
                edit, state = "K", keep
            else:
                edit, state = role[0].upper(), due
            codes[-1] += edit
            row += 1
            codes.append("")
        else:
            codes[-1] += role[0]
            state = due
    tail = codes.pop()
    if codes:
        codes[-1] += tail
    elif tail:
        codes.append(tail)
    return codes, state


#: From a row's letters to the audit's.
AUDIT = str.maketrans("uaUA", "IIRR")


def turns_of(code: str, role: str, text: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what a row's letters leave of it and put around it."""
    for letter in code:
        if letter in "ua":
            yield "I", "user" if letter == "u" else "assistant", ""
        elif letter in "UA":
            yield "R", "user" if letter == "U" else "assistant", text
        elif letter == "K":
            yield "K", role, text


def damage(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows, damaged by the hash of their key; dropped rows stay as markers."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = convs.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    gone = F.col("kind") == 0
    return rows.select("conv_id", "turn", F.when(~gone, role).alias("role"), F.when(~gone, text).alias("text"), gone.alias("gone"), copies.alias("copy")).drop("copy")


def undamaged(convs: DataFrame) -> DataFrame:
    """The rows as ``report`` and ``repaired`` take them."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    return convs.select("conv_id", "turn", blank("role"), blank("text"), F.lit(False).alias("gone"))


def _key() -> Column:
    """A conversation's key, never null."""
    return F.when(F.col("conv_id").isNull(), "none").otherwise(F.concat(F.lit("id "), F.col("conv_id").cast("string")))


_ORDER = ("conv", "turn", "role", "h1")  # ascending, nulls first
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "place long, edit string, role string, text string"


def _fault(text: str, again: bool) -> int:
    body = text.strip(SPACES)
    return BLANK if not body else DUPLICATE if again else OK if body[-1] in STOPS else CUT_SHORT


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of conversations of at most BLOCK_ROWS rows, and the others' if there are any."""
    rows = rows.select(_key().alias("conv"), "conv_id", "turn", "role", "text", "gone", F.xxhash64("text").alias("h1"))
    sizes = cut(rows.where("not gone").groupBy("conv").count().where(F.col("count") > BLOCK_ROWS).select("conv"))
    n = sizes.count()
    if not n:
        return rows, None
    ids = broadcast_below(sizes, 64 * n)
    return rows.join(ids, "conv", "left_anti"), rows.join(ids, "conv", "left_semi").where("not gone")


def _short(rows: DataFrame, report: bool) -> DataFrame:
    kind = dict(rows.dtypes)["conv_id"]

    def examined(found: list[tuple]) -> Iterator[tuple]:
        initials, faults, seen, turns = [], [], set(), []
        for turn, role, text in found:
            faults.append(_fault(text, (role, text) in seen))
            seen.add((role, text))
            initials.append(role[:1])
            turns += [turn] * (turn is not None)
        reach = distances(initials, faults)
        codes, _ = walk(initials, faults, reach)
        made = (t for i, code in enumerate(codes) for t in turns_of(code, *(found[i][1:] if found else ("", ""))))
        if not report:
            yield from ((place, *turn) for place, turn in enumerate(made))
            return
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        lines = "\n".join(f"{role}:{text}" for _, role, text in made)
        yield gaps, *(faults.count(f) for f in (BLANK, DUPLICATE, CUT_SHORT)), illegal, reach[START], "".join(codes).translate(AUDIT), hashlib.sha256(lines.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, found, out = None, None, [], []

        def flush() -> pa.RecordBatch:
            names = schema.names
            return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*out, strict=True), schema, strict=True)], names=names)

        schema = None
        for batch in batches:
            if schema is None:
                fields = [f.strip().split() for f in (_REPORT if report else _TURNS).split(",")]
                schema = pa.schema([batch.schema.field("conv_id"), *((name, pa.int64() if t == "long" else pa.string()) for name, t in fields)])
            for conv, conv_id, turn, role, text, gone in zip(*(batch.column(c).to_pylist() for c in ("conv", "conv_id", "turn", "role", "text", "gone")), strict=True):
                if conv != key:
                    if key is not None:
                        out += [(own, *x) for x in examined(found)]
                        if len(out) >= 1000:
                            yield flush()
                            out = []
                    key, own, found = conv, conv_id, []
                if not gone:
                    found.append((turn, role, text))
        if key is not None:
            out += [(own, *x) for x in examined(found)]
            if out:
                yield flush()

    placed = rows.repartition("conv").sortWithinPartitions(*_ORDER, "text")
    return placed.mapInArrow(run, f"conv_id {kind}, {_REPORT if report else _TURNS}")


def _long(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows in order with their edits, and the counts of each conversation: (conv, conv_id, at, role, text, code), (conv, gaps, ...)."""
    placed = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER, "text")
    placed = cut(placed.withColumn("at", F.monotonically_increasing_id()).withColumn("block", F.expr(f"at div {BLOCK_ROWS}")))
    same = ["conv", "role", "h1", "h2"]
    marked = placed.withColumn("h2", F.xxhash64(F.lit(1), "text"))
    first = marked.groupBy(*same).agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    light = marked.select(*same, "turn", "at", "block", F.substring("role", 1, 1).alias("initial"), last.alias("last")).join(first, same, "left")
    again = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    fault = F.when(F.col("last") == "", BLANK).when(again, DUPLICATE).when(F.col("last").isin(*STOPS), OK).otherwise(CUT_SHORT)
    light = cut(light.select("conv", "turn", "at", "block", "initial", fault.alias("fault")))
    blocks = cut(light.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("at", "initial", "fault"))).alias("rows")))  # BLOCK_ROWS at most

    costs = blocks.mapInPandas(_block_costs, "conv string, block long, costs array<long>, head string, tail string, illegal long")
    goals = costs.groupBy("conv").applyInPandas(_goals, "conv string, block long, goals array<long>, illegal long, cost long")
    goals = cut(goals)
    ways = cut(
        blocks.join(goals.select("conv", "block", "goals"), ["conv", "block"])
        .mapInPandas(_block_walks, "conv string, block long, ends array<int>, ats array<long>, codes array<array<string>>")
    )
    starts = ways.select("conv", "block", "ends").groupBy("conv").applyInPandas(_starts, "conv string, block long, start int")
    codes = ways.join(starts, ["conv", "block"]).select(F.explode(F.arrays_zip("ats", F.get("codes", F.col("start")).alias("code"))).alias("x")).select(F.col("x.ats").alias("at"), "x.code")
    edited = placed.select("conv", "conv_id", "at", "role", "text").join(codes, "at")

    turns = light.groupBy("conv", "turn").agg(F.count("*").alias("n"), *[F.count_if(F.col("fault") == f).alias(name) for f, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT_SHORT, "truncated"))])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    counts = turns.groupBy("conv").agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    totals = goals.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"))
    return edited, counts.join(totals, "conv")


def _block_costs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block the cost from every state before it to every state after it, and what its neighbours need to count illegal turns."""
    for frame in frames:
        out = []
        for conv, block, rows in frame.itertuples(index=False):
            initials, faults = [r["initial"] for r in rows], [r["fault"] for r in rows]
            ends = [distances(initials, faults, tuple(0 if s == end else FAR for s in range(STATES)))[:STATES] for end in range(STATES)]
            bad = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
            out.append((conv, block, [ends[end][s] for s in range(STATES) for end in range(STATES)], initials[0], initials[-1], bad))
        yield pd.DataFrame(out, columns=["conv", "block", "costs", "head", "tail", "illegal"])


def _goals(blocks: pd.DataFrame) -> pd.DataFrame:
    """The distances at the end of each block, composed from the last block backwards; one row a block."""
    blocks = blocks.sort_values("block", ignore_index=True)
    goals, out = list(GOALS), []
    for i in range(len(blocks) - 1, -1, -1):
        seam = int(i > 0 and blocks["tail"][i - 1] + blocks["head"][i] not in LEGAL)
        costs = blocks["costs"][i]
        before = [min(min(int(costs[STATES * s + end]) + goals[end], FAR) for end in range(STATES)) for s in range(STATES)]
        out.append((blocks["conv"][i], blocks["block"][i], goals, int(blocks["illegal"][i]) + seam, before[START] if i == 0 else 0))
        goals = before
    return pd.DataFrame(out, columns=["conv", "block", "goals", "illegal", "cost"])


def _block_walks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block and each state before it, the edits and the state after it."""
    for frame in frames:
        out = []
        for conv, block, rows, goals in frame[["conv", "block", "rows", "goals"]].itertuples(index=False):
            initials, faults, goals = [r["initial"] for r in rows], [r["fault"] for r in rows], tuple(map(int, goals))
            reach = distances(initials, faults, goals)
            walks = [walk(initials, faults, reach, goals, s) for s in range(STATES)]
            out.append((conv, block, [end for _, end in walks], [r["at"] for r in rows], [codes for codes, _ in walks]))
        yield pd.DataFrame(out, columns=["conv", "block", "ends", "ats", "codes"])


def _starts(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state before each block, from the first block on."""
    blocks = blocks.sort_values("block", ignore_index=True)
    state, starts = START, []
    for ends in blocks["ends"]:
        starts.append(state)
        state = int(ends[state])
    return pd.DataFrame({"conv": blocks["conv"], "block": blocks["block"], "start": starts})


def _streamed(edited: DataFrame, report: bool) -> DataFrame:
    """Audit and digest, or the turns, of conversations whose rows stream past in order."""
    kind = dict(edited.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, letters, digest, place = None, [], hashlib.sha256(), 0

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"conv": [key], "audit": ["".join(letters).translate(AUDIT)], "repaired_sha256": [digest.hexdigest()]})

        for batch in batches:
            made = []
            for conv, conv_id, role, text, code in zip(*(batch.column(c).to_pylist() for c in ("conv", "conv_id", "role", "text", "code")), strict=True):
                if conv != key:
                    if report and key is not None:
                        yield told()
                    key, letters, digest, place = conv, [], hashlib.sha256(), 0
                letters.append(code)
                for turn in turns_of(code, role, text):
                    if report:
                        digest.update(("\n" * (place > 0) + f"{turn[1]}:{turn[2]}").encode())
                    else:
                        made.append((conv_id, place, *turn))
                    place += 1
            if made:
                types = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names=["conv_id", "place", "edit", "role", "text"])
                letters = []
        if report and key is not None:
            yield told()

    schema = "conv string, audit string, repaired_sha256 string" if report else f"conv_id {kind}, {_TURNS}"
    return edited.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(run, schema)


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (as ``damage`` and ``undamaged`` give them): conv_id, its faults, the least cost, the audit, the digest of the repair."""
    short, long = _split(rows)
    found = _short(short, True)
    if long is None:
        return found
    edited, counts = _long(long)
    edited = cut(edited)
    ids = edited.groupBy("conv").agg(F.first("conv_id", ignorenulls=True).alias("conv_id"))
    return found.unionByName(counts.join(_streamed(edited, True), "conv").join(ids, "conv").select(*found.columns))


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of every repaired conversation in order."""
    short, long = _split(rows)
    found = _short(short, False)
    return found if long is None else found.unionByName(_streamed(_long(long)[0], False))


def _add(cost: str, letter: str, path: str) -> str:
    return f"printf('%09d', {cost} + substr({path}, 1, 9)::BIGINT) || '{letter}' || substr({path}, 10)"


def _step(state: int) -> str:
    """The least path from a state before row r, without insertions there, in DuckDB."""
    due = DUE[state][1]
    keeps = " ".join(f"WHEN r.initial = '{i}' THEN {_add('r.more', 'K', f'f{after}')}" for i, after in KEPT[state].items())
    return f"least({_add(str(DELETE), 'D', f'f{state}')}, CASE WHEN r.fault NOT IN ({BLANK}, {DUPLICATE}) THEN least({_add(f'{REROLE} + r.more', 'R', f'f{due}')}, CASE {keeps} END) END)"


def _closed(v: list[str]) -> str:
    two, three = f"least({v[2]}, {_add(str(INSERT), 'I', v[3])})", f"least({v[3]}, {_add(str(INSERT), 'I', v[2])})"
    return ", ".join([f"least({v[0]}, {_add(str(INSERT), 'I', f'({two})')})", f"least({v[1]}, {_add(str(INSERT), 'I', f'({two})')})", two, three])


ORACLE = rf"""
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS v FROM range(256) x(b))
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), kinds AS (
  SELECT * EXCLUDE (k, t), xor(list_reduce(list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS kind FROM keyed, tab
), hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM hurt
), judged AS (
  SELECT *, CASE WHEN last = '' THEN {BLANK} WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN {DUPLICATE} WHEN last IN ('.', '!', '?') THEN {OK} ELSE {CUT_SHORT} END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier FROM placed
), r AS (
  SELECT *, CASE fault WHEN {CUT_SHORT} THEN {TRUNCATED} ELSE 0 END AS more FROM judged
), path(conv_id, i, f0, f1, f2, f3) AS (
  SELECT conv_id, max(pos), '000000000', '000000004II', '000000002I', '000000000' FROM r GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i - 1, {_closed(["v0", "v1", "v2", "v3"])} FROM (SELECT path.conv_id, i, {", ".join(f"{_step(s)} AS v{s}" for s in range(STATES))} FROM path JOIN r ON r.conv_id IS NOT DISTINCT FROM path.conv_id AND r.pos = path.i)
), best AS (
  SELECT conv_id, substr(f0, 1, 9)::BIGINT AS cost, substr(f0, 10) AS audit FROM path WHERE i = 0
), mend(conv_id, audit, k, i, state, lines) AS (
  SELECT conv_id, audit, 1, 1::BIGINT, 0, []::VARCHAR[] FROM best
  UNION ALL
  SELECT m.conv_id, audit, k + 1, CASE WHEN e = 'I' THEN i ELSE i + 1 END,
    CASE WHEN e = 'D' THEN state WHEN e = 'K' AND initial = 's' THEN 1 WHEN state = 2 THEN 3 ELSE 2 END,
    CASE e WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      ELSE list_append(lines, CASE WHEN state = 2 THEN 'assistant:' ELSE 'user:' END || CASE e WHEN 'R' THEN text ELSE '' END) END
  FROM (SELECT *, substr(audit, k, 1) AS e FROM mend WHERE k <= length(audit)) m LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM m.conv_id AND r.pos = m.i
), done AS (
  SELECT conv_id, sha256(array_to_string(lines, chr(10))) AS digest FROM mend WHERE k = length(audit) + 1
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = {BLANK}) AS blank, count(*) FILTER (fault = {DUPLICATE}) AS duplicate,
    count(*) FILTER (fault = {CUT_SHORT}) AS truncated, count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
"""
