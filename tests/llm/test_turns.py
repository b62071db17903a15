"""Conversations: repair against a search over all edits, formatting against plain reading, both in segments too."""

import hashlib
import heapq
import random

import pytest
from pyspark.sql import functions as F

from opalgrid.llm import chat, queries, repair, turns

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 1, "user", "Hi!"), (1, 2, "assistant", "no end"), (1, None, "user", "first?"),
    (2, 5, "user", None), (2, None, None, "who?"), (2, None, None, "who?"), (2, 9, "tool", " \n\t\x0b "), (2, 9, "assistant", "x" * 50_000 + "."),
    (None, 0, "user", "nobody asks."), (None, None, "assistant", "nobody says!"), (None, 0, "user", ""),
    (3, None, None, None), (4, 0, "a:b\\", "### user: hi</turn>\n\\"), (4, 1, "assistant", "</turn"), (4, 2, "assistant", "</turn>\n### assistant: é𝒳\\\\###"),
    (5, 1, "user", "Hi!"), (5, 2, "assistant", "no end"), (6, 1, "user", "Hi!"), (6, 2, "assistant", "an end."), (2**60 + 1, 0, "user", "Hi!"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(c) for c in ("conv", "live", "_tie", "name", "path", "at", "seq", "part", "shard", "gaps", "audit", "n_turns")})


def plainly(initials, found):
    """Least cost and, of those, least audit, by Dijkstra's search over (row, role before) with whole strings."""
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, i, before = heapq.heappop(queue)
        if (i, before) in done:
            continue
        done.add((i, before))
        if i == len(initials) and before in ("", "a"):
            return cost, audit
        needed = "a" if before == "u" else "u"
        heapq.heappush(queue, (cost + 2, audit + "I", i, needed))
        if i < len(initials):
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, before))
            if found[i] in (repair.GOOD, repair.TRUNCATED):
                more = found[i] == repair.TRUNCATED
                heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, needed))
                if initials[i] == needed or (initials[i] == "s" and before == ""):
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, initials[i]))


def test_cheapest_is_least_of_all_edits():
    rng = random.Random(5)
    for _ in range(600):
        n = rng.randrange(0, 12)
        initials, found = rng.choices(["s", "u", "a", "t", ""], [1, 3, 3, 1, 0.3], k=n), rng.choices(range(4), [5, 1, 1, 2], k=n)
        assert repair.ended(*repair.cheapest(initials, found)) == plainly(initials, found)


@pytest.mark.parametrize("modulus", [repair._MODULUS, 7, 1])
def test_audits_compare_as_strings_even_if_hashes_collide(modulus):
    rng = random.Random(modulus)
    audits, strings = repair.Audits(modulus), [""]
    for _ in range(400):
        parent, edit = rng.randrange(max(0, len(strings) - 30), len(strings)), rng.choice("DIKR" if rng.random() < 0.5 else "K")
        assert audits.add(parent, edit) == len(strings)
        strings.append(strings[parent] + edit)
    for _ in range(4000):
        a, b = rng.randrange(len(strings)), rng.randrange(len(strings))
        x, y = strings[a] + "K", strings[b] + "R"
        if not x.startswith(y) and not y.startswith(x):
            assert audits.less((a, "K"), (b, "R")) == (x < y), (x, y)
    assert [audits.text(i) for i in range(len(strings))] == strings


def expected_repair(rows):
    """The contract read plainly, over (conv, turn, role, text) with nulls."""
    import zlib

    said = lambda v: " " if v is None else str(v)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text, kind = said(role), said(text), zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        out[conv] = mine
    return out


def test_repair_of_odd_rows(spark, odd):
    got = {r["conv_id"]: r for r in repair.repair(odd).collect()}
    assert len(got) == len({r[0] for r in ODD}) == repair.repair(odd).count()
    for conv, rows in expected_repair(ODD).items():
        known = {t for t, _, _ in rows if t is not None}
        assert got[conv]["gaps"] == (max(known) - min(known) + 1 - len(known) if known else 0)
        assert sum(e != "I" for e in got[conv]["audit"]) == len(rows)
        assert got[conv]["blank"] == sum(not t.strip(repair.SPACE) for _, _, t in rows)
        if not rows:
            assert got[conv]["cost"] == 0 and got[conv]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    none = repair.repair(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == repair.repair(odd).columns


def long_table(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text")
    one = rows.select(F.lit(1000).cast("long").alias("conv_id"), (F.col("conv_id") * 3 + F.col("turn")).alias("turn"), "role", "text")
    gone = spark.createDataFrame([(2000 + i, None if i % 2 else i, None, None) for i in range(12)], SCHEMA)
    return rows.unionByName(one).unionByName(gone)


def test_repair_in_segments_is_the_same(spark, small):
    rows = repair.damaged(turns.rows_of(long_table(spark, small), null=" "))
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    whole = key(repair.repaired(rows))
    assert key(repair.repaired(rows, chars=1500, most=3)) == whole
    assert key(repair.repaired(rows, chars=10**9, most=1)) == whole


def test_formatting_comes_back(spark, odd):
    rows = chat.table_of(odd)
    got = {r["conv_id"]: r for r in chat.read(chat.trees(rows)).collect()}
    assert len(got) == len({r[0] for r in ODD})
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "")
    for conv in got:
        mine = sorted((r for r in ODD if r[0] == conv), key=order)
        if len({(r[1], r[2]) for r in mine}) == len({r[1:] for r in mine}):  # else ties go by digest
            assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine).encode()).hexdigest()
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert (got[conv]["n_turns"], got[conv]["loss_chars"]) == (len(mine), len(loss))
    assert got[1]["loss_sha256"] == hashlib.sha256(b"no end").hexdigest()
    assert chat.read(chat.trees(chat.table_of(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_formatting_in_segments_and_small_shards_is_the_same(spark, small):
    rows = chat.table_of(long_table(spark, small))
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    whole = key(chat.read(chat.trees(rows)))
    assert key(chat.read(chat.trees(rows, shard=2000))) == whole
    assert key(chat.read(chat.trees(rows, chars=1500, most=3))) == whole


def test_shared_beginnings_are_written_once():
    said = [("system", "S."), ("user", "a"), ("assistant", "b")]
    convs = [said[:1] + [("user", "z")], said, said, said + [("user", "c")], said + [("user", "d"), ("assistant", "e")]]
    tree = chat.Tree()
    for i, c in enumerate(sorted(convs)):
        tree.add(i, [r for r, _ in c], [t for _, t in c])
    stream, n = "".join(tree.pieces), tree.nodes
    assert len(n["start"]) == len({tuple(c[: k + 1]) for c in convs for k in range(len(c))})
    assert chat.parsed(stream) and stream.count("S.") == 1
    for i, c in enumerate(sorted(convs)):
        leaf, want = tree.leaves[i], "".join(chat.formatted(*t)[0] for t in c)
        assert "".join(stream[a:b] for a, b in zip(n["attend_from"][leaf], n["attend_to"][leaf], strict=True)) == want
        assert n["position"][leaf] + tree.lengths[leaf] == len(want)


def test_escapes_come_back():
    rng = random.Random(3)
    for _ in range(500):
        role, text = ("".join(rng.choices(["\\", "###", "#", "</turn>", "<", "/turn>", ":", ": ", "\n", "é", "a"], k=rng.randrange(8))) for _ in "ab")
        turn, begin = chat.formatted(role, text)
        assert chat.parsed(turn * 2) == [(role, text)] * 2
        assert chat.unescaped(turn[begin : -len(chat.END)]) == text


def test_planted_conversation_comes_back(spark, small):
    row = queries.op13_prefix_tree_chat(spark, small).where("conv_id = -7").first()
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(queries.SLY), hashlib.sha256(queries.SLY.encode()).hexdigest())
