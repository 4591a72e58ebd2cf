from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from riskweave.llm import conversation_repair as c
from tests.conftest import DATA
from tests.oracle import assert_same, connect

FULL = re.compile(r"(s?(ua)+)?")


def cheapest(rows, faults):
    """The least (cost, audit) and its lines, by trying paths in order of cost and then letters."""
    heap = [(0, "", 0, "", ())]
    bound = 3 * len(rows) + 1
    while heap:
        cost, audit, i, initials, lines = heapq.heappop(heap)
        if i == len(rows) and FULL.fullmatch(initials):
            best = min((x for x in [(cost, audit, i, initials, lines), *heap] if x[0] == cost and x[2] == len(rows) and FULL.fullmatch(x[3])), key=lambda x: x[1])
            return best[0], best[1], best[4]
        options = [("I", i, r[0], 2, (f"{r}:",)) for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            options.append(("D", i + 1, "", 3, ()))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                options.append(("K", i + 1, role[:1], more, (f"{role}:{text}",)))
                options += [("R", i + 1, r[0], 2 + more, (f"{r}:{text}",)) for r in ("user", "assistant")]
        for letter, at, initial, more, line in options:
            if (letter in "KR" and not initial) or cost + more > bound or not re.fullmatch(r"s?(ua)*u?", initials + initial):
                continue
            heapq.heappush(heap, (cost + more, audit + letter, at, initials + initial, lines + line))
    return None


def plain(table):
    """The contract over (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        turns, seen, faults = [r[0] for r in rows if r[0] is not None], set(), []
        for _, role, text in rows:
            left = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, lines = cheapest([r[1:] for r in rows], faults)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def got(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def made(seed=5, convs=60):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Really?", "cut off", "", " \t", None, "Ünï. ", "a\nb."]
    rows = []
    for conv in [*range(convs), None]:
        turns = rng.choice([list(range(rng.randint(1, 5))), [None, 3, 9], [None, None]])
        for turn in turns:
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rng.choice(texts)))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [4096, 2])
def test_against_trying_all_paths(spark, monkeypatch, block):
    rows = [r for r in made() if r[1] is not None or r[3] == "Yes."]  # rows with equal turns are ordered by a hash
    monkeypatch.setattr(c, "BLOCK_ROWS", block)
    assert got(c.report(c.damage(spark.createDataFrame(rows, SCHEMA)))) == plain(rows)


@pytest.mark.parametrize("block", [4096, 2])
def test_against_sql(spark, monkeypatch, block):
    monkeypatch.setattr(c, "BLOCK_ROWS", block)
    assert_same(c.report(c.damage(spark.read.parquet(f"{DATA}/conversations.parquet"))).toPandas(), connect(DATA).sql(c.ORACLE).df())


def test_blocks_agree_with_whole_conversations(spark, monkeypatch):
    rows = [(7, i // 2, random.Random(i).choice(["user", "assistant", "system"]), random.Random(-i).choice(["Yes.", "No", "", f"t{i}."])) for i in range(3000)]
    rows += made(8)
    df = c.damage(spark.createDataFrame(rows, SCHEMA))
    whole, turns = got(c.report(df)), c.repaired(df).orderBy("conv_id", "place").collect()
    monkeypatch.setattr(c, "BLOCK_ROWS", 50)
    assert got(c.report(df.repartition(5))) == whole
    assert c.repaired(df.repartition(5)).orderBy("conv_id", "place").collect() == turns
    lines = {}
    for t in turns:
        lines.setdefault(t.conv_id, []).append(f"{t.role}:{t.text}")
    for row in whole:
        assert hashlib.sha256("\n".join(lines.get(row[0], [])).encode()).hexdigest() == row[-1]


def test_distances_and_walks_of_every_short_conversation():
    for n in range(4):
        for initials in itertools.product("usax", repeat=n):
            for faults in itertools.product((c.OK, c.BLANK, c.CUT_SHORT), repeat=n):
                reach = c.distances(list(initials), list(faults))
                codes, end = c.walk(list(initials), list(faults), reach)
                names = {c.OK: "", c.BLANK: "blank", c.CUT_SHORT: "truncated"}
                rows = [({"u": "user", "s": "system", "a": "assistant", "x": "x"}[i], "t") for i in initials]
                cost, audit, lines = cheapest(rows, [names[f] for f in faults])
                assert (reach[c.START], "".join(codes).translate(c.AUDIT)) == (cost, audit)
                assert end in c.ENDS
                assert [f"{r}:{t}" for (role, text), code in zip(rows, codes, strict=False) for _, r, t in c.turns_of(code, role, text)] == list(lines)


def test_dropped_conversations_extra_columns_and_empty_tables(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi."), (gone, 0, "user", "Hi.")], SCHEMA)
    extra = df.select("*", *[F.lit(1).alias(x) for x in ("conv", "kind", "gone", "h1", "at", "block", "code", "a.b", "c`d", "copy", "fault")])
    empty = hashlib.sha256(b"").hexdigest()
    assert got(c.report(c.damage(extra))) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    assert c.report(c.damage(df.where("false"))).collect() == []
    plain_rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Well")], SCHEMA)
    assert [(r.edit, r.role, r.text) for r in c.repaired(c.undamaged(plain_rows)).orderBy("place").collect()] == [("K", "user", "Hi."), ("K", "assistant", "Well")]
