"""Repair of the structure of conversations: the cheapest edits that make turns alternate, and an audit string of them.

Turns are read in order by an automaton with four states (nothing yet, after a system turn, after user, after assistant). For
each state the best edits so far are kept: least cost, and of those the least audit. Audits are linked nodes that share
prefixes; a node knows its ancestors 1, 2, 4, ... edits back and a rolling hash of its audit. Two audits of equal cost are
compared at the end of their longest common prefix, which is found by descending over ancestors with equal hashes and then
verified edit by edit. Two audits of one state and one row that cost the same are never prefixes of each other (the longer one
would have more insertions), so the lesser one stays the lesser whatever follows.

A conversation beyond the bounds of turns.gathered is repaired by segments: each gives the best edits from every state to
every state, which compose.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opalgrid.llm.common import claim, cut, stored
from opalgrid.llm.turns import CHARS, ROWS, gathered, rows_of

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
GOOD, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn of this role is added, or None where it may not be.
NEXT = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT,
}
#: Role that a rerole or an insertion gives in each state.
ROLE = {NOTHING: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
SPACE = " \t\n\v\f\r"
_MODULUS, _BASE = (1 << 61) - 1, 911_382_323_914_577_901


class Audits:
    """Edit strings as linked nodes. Node 0 is the empty one."""

    def __init__(self, modulus: int = _MODULUS) -> None:
        self.modulus = modulus
        self.edit, self.depth, self.hash = [""], [0], [0]
        self.up: list[tuple[int, ...]] = [()]
        self.same: set[tuple[int, int]] = set()  # pairs whose audits were verified to be equal

    def add(self, parent: int, edit: str) -> int:
        node, ups = len(self.edit), [parent]
        while len(self.up[ups[-1]]) >= len(ups):  # 2 ** k back is 2 ** (k - 1) back, twice
            ups.append(self.up[ups[-1]][len(ups) - 1])
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % self.modulus)
        self.up.append(tuple(ups))
        return node

    def ancestor(self, node: int, depth: int) -> int:
        back = self.depth[node] - depth
        while back:
            k = back.bit_length() - 1
            node, back = self.up[node][k], back - (1 << k)
        return node

    def _equal(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth have the same audit: hashes first, then edit by edit to a shared node."""
        if self.hash[a] != self.hash[b]:
            return False
        walked = []
        while a != b and (a, b) not in self.same:
            if self.edit[a] != self.edit[b]:
                return False
            walked.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        self.same.update(walked)
        return True

    def common(self, a: int, b: int) -> tuple[int, int]:
        """The nodes right after the longest common prefix of two audits of which neither is a prefix of the other."""
        least = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, least), self.ancestor(b, least)
        begin = a, b
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if not self._equal(self.up[a][0], self.up[b][0]):  # hashes collided above: look at every edit
            a, b = begin
            found = a, b
            while a != b:
                found = (a, b) if self.edit[a] != self.edit[b] else found
                a, b = self.up[a][0], self.up[b][0]
            return found
        return a, b

    def less(self, a: tuple[int, str], b: tuple[int, str]) -> bool:
        """Whether audit a (node, and one more edit) comes before audit b; neither is a prefix of the other."""
        (x, p), (y, q) = a, b
        if x == y or (self.depth[x] == self.depth[y] and self._equal(x, y)):
            return p < q
        if self.depth[x] != self.depth[y]:  # the longer one's prefix may be the whole shorter one: compare its next edit
            deep, at = (x, self.depth[y]) if self.depth[x] > self.depth[y] else (y, self.depth[x])
            lower = self.ancestor(deep, at)
            if self._equal(lower, y if deep == x else x):
                follow = self.edit[self.ancestor(deep, at + 1)]
                if follow != (q if deep == x else p):
                    return follow < q if deep == x else p < follow
                return deep == y
        x, y = self.common(x, y)
        return self.edit[x] < self.edit[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))


Best = list[tuple[int, int] | None]  # for each state: cost, node


def stepped(audits: Audits, best: Best, initial: str, fault: int) -> Best:
    """The best of each state after a row, and after insertions that may follow."""
    new: list[tuple[int, tuple[int, str]] | None] = [None] * 4

    def offer(state: int, cost: int, audit: tuple[int, str]) -> None:
        old = new[state]
        if old is None or cost < old[0] or (cost == old[0] and audits.less(audit, old[1])):
            new[state] = cost, audit

    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    for state, one in enumerate(best):
        if one is None:
            continue
        cost, node = one
        offer(state, cost + COST[DELETE], (node, DELETE))
        if fault in (GOOD, TRUNCATED):
            kept = NEXT.get((state, initial))
            if kept is not None:
                offer(kept, cost + COST[KEEP] + extra, (node, KEEP))
            offer(NEXT[state, ROLE[state][0]], cost + COST[REROLE] + extra, (node, REROLE))
    return inserted(audits, [x and (x[0], audits.add(*x[1])) for x in new])


def inserted(audits: Audits, best: Best) -> Best:
    """The best of each state where turns may be inserted: two in a row at most are ever worth it."""
    best = list(best)
    for state in (NOTHING, SYSTEM, ASSISTANT, USER):
        if best[state] is None:
            continue
        cost, to = best[state][0] + COST[INSERT], NEXT[state, ROLE[state][0]]
        old = best[to]
        audit = (best[state][1], INSERT)
        if old is None or cost < old[0] or (cost == old[0] and audits.less(audit, (audits.up[old[1]][0], audits.edit[old[1]]) if old[1] else (0, ""))):
            best[to] = cost, audits.add(*audit)
    return best


def faults(roles: Sequence[str], texts: Sequence[str], seen: set[tuple[str, str]] | None = None) -> list[int]:
    """The first fault of each row, in order: blank, duplicate (role and text were there before), truncated."""
    seen, out = set() if seen is None else seen, []
    for role, text in zip(roles, texts, strict=True):
        said = text.rstrip(SPACE)
        out.append(BLANK if not said else DUPLICATE if (role, text) in seen else TRUNCATED if said[-1] not in ".!?" else GOOD)
        seen.add((role, text))
    return out


def cheapest(initials: Sequence[str], found: Sequence[int], begin: int = NOTHING) -> tuple[Audits, Best]:
    """The best edits from state `begin` to each state."""
    audits = Audits()
    best: Best = [None] * 4
    best[begin] = 0, 0
    best = inserted(audits, best)
    for initial, fault in zip(initials, found, strict=True):
        best = stepped(audits, best, initial, fault)
    return audits, best


def ended(audits: Audits, best: Best) -> tuple[int, str]:
    """Cost and audit of the better of both states that may end a conversation."""
    a, b = best[NOTHING], best[ASSISTANT]
    if a is None or (b is not None and b[0] < a[0]):
        a = b
    elif b is not None and a[0] == b[0]:
        return a[0], min(audits.text(a[1]), audits.text(b[1]))
    return a[0], audits.text(a[1])


def lines(audit: str, roles: Sequence[str], texts: Sequence[str], state: int = NOTHING) -> Iterator[str]:
    """The repaired turns as role:text, given the state before the first."""
    i = 0
    for edit in audit:
        if edit == DELETE:
            i += 1
            continue
        role = roles[i] if edit == KEEP else ROLE[state]
        yield f"{role}:{'' if edit == INSERT else texts[i]}"
        state = NEXT[state, role[:1]]
        i += edit != INSERT


def gaps_of(turns: Sequence[int]) -> tuple[int, int, int] | None:
    """Least, greatest and number of different turns that are known."""
    known = {int(t) for t in turns if t is not None and t == t}
    return (min(known), max(known), len(known)) if known else None


def wrong_pairs(initials: Sequence[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired_one(turns: Sequence[int], roles: Sequence[str], texts: Sequence[str]) -> tuple:
    """The results of one conversation."""
    found, initials = faults(roles, texts), [r[:1] for r in roles]
    cost, audit = ended(*cheapest(initials, found))
    span = gaps_of(turns)
    whole = hashlib.sha256("\n".join(lines(audit, roles, texts)).encode("utf-8", "surrogatepass")).hexdigest()
    return (span[1] - span[0] + 1 - span[2] if span else 0, *[found.count(k) for k in (BLANK, DUPLICATE, TRUNCATED)], wrong_pairs(initials), cost, audit, whole)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with damage that depends on conversation and turn; live is false for dropped ones."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))
    return rows.withColumn("_kind", kind).select("conv", "turn", role.alias("role"), text.alias("text"), (F.col("_kind") != 0).alias("live"), F.explode(times).alias("_copy")).drop("_copy")


def repaired(rows: DataFrame, *, chars: int = CHARS, most: int = ROWS) -> DataFrame:
    """conv and the results of the repair for each conversation of rows (conv, turn, role, text, live); see turns.gathered."""
    whole, parts = gathered(rows, chars=chars, most=most)

    @F.pandas_udf(f"struct<{RESULT.replace(' long', ': long').replace(' string', ': string')}>")
    def work(turns: pd.Series, roles: pd.Series, texts: pd.Series) -> pd.DataFrame:
        claim("turns")
        out = [repaired_one([*t], [*r], [*x]) for t, r, x in zip(turns, roles, texts, strict=True)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])

    there = F.filter(F.arrays_zip("turn", "role", "text", "live"), lambda x: x["live"])
    done = whole.select("conv", there.alias("_r")).select("conv", work("_r.turn", "_r.role", "_r.text").alias("_x")).select("conv", "_x.*")
    return done.unionByName(repaired_long(parts))


def _numbered(parts: DataFrame) -> DataFrame:
    """Segments with at = their number within the conversation."""
    order = Window.partitionBy("conv").orderBy("part", "seq")
    places = parts.select(F.col("conv").alias("_conv"), F.col("part").alias("_part"), F.col("seq").alias("_seq"), (F.row_number().over(order).cast("long") - 1).alias("at"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("seq") == F.col("_seq"))
    return parts.join(places, same).select("conv", "at", "turn", "role", "text", "live")


def repaired_long(parts: DataFrame) -> DataFrame:
    """The same for conversations in segments. Texts stay in their segments until they are hashed, in order; a task holds one
    segment, or one edit letter and 24 bytes for each row of a conversation."""
    rows = F.filter(F.arrays_zip("turn", "role", "text", "live"), lambda x: x["live"])
    held = stored(_numbered(parts).select("conv", "at", rows.alias("_r")).select("conv", "at", "_r.turn", "_r.role", "_r.text"), "segments")

    # Rows whose role and text an earlier segment has: each segment tells its different ones once.
    one = held.select("conv", "at", F.explode(F.array_distinct(F.transform(F.arrays_zip("role", "text"), lambda x: F.md5(F.concat_ws(":", F.length(x["role"]), x["role"], x["text"]))))).alias("digest"))
    first = one.groupBy("conv", "digest").agg(F.min("at").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    again = one.alias("o").join(first.alias("f"), F.col("o.conv").eqNullSafe(F.col("f.conv")) & (F.col("o.digest") == F.col("f.digest"))).where("at > _first")
    earlier = again.groupBy("o.conv", "at").agg(F.collect_set("o.digest").alias("earlier"))
    told = held.alias("h").join(earlier.alias("e"), F.col("h.conv").eqNullSafe(F.col("e.conv")) & (F.col("h.at") == F.col("e.at")), "left").select("h.*", "earlier")

    counts = ["blank", "duplicate", "truncated", "illegal"]
    columns = [*counts, "ends", "least", "greatest", "known", "costs", "audits"]
    summary = "struct<blank: long, duplicate: long, truncated: long, illegal: long, ends: array<string>, least: long, greatest: long, known: long, costs: array<long>, audits: array<string>>"

    @F.pandas_udf(summary)
    def summed(turns: pd.Series, roles: pd.Series, texts: pd.Series, before: pd.Series) -> pd.DataFrame:
        claim("turns")
        out = []
        for t, r, x, b in zip(turns, roles, texts, before, strict=True):
            had = set(b) if b is not None else set()
            own = {p for p in zip(r, x, strict=True) if had and hashlib.md5(f"{len(p[0])}:{p[0]}:{p[1]}".encode()).hexdigest() in had}
            found, initials = faults(r, x, own), [c[:1] for c in r]
            made = [cheapest(initials, found, begin) for begin in range(4)]
            costs = [one[0] if one else -1 for _, best in made for one in best]
            audits = [nodes.text(one[1]) if one else "" for nodes, best in made for one in best]
            out.append((*[found.count(k) for k in (BLANK, DUPLICATE, TRUNCATED)], wrong_pairs(initials), initials[:1] + initials[-1:], *(gaps_of(t) or (None, None, 0)), costs, audits))
        return pd.DataFrame(out, columns=columns).astype({"least": "Int64", "greatest": "Int64"})

    def composed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        best: list[tuple[int, str] | None] = [(0, ""), None, None, None]
        choices = []
        for costs, audits in zip(rows["costs"], rows["audits"], strict=True):
            offers = [[(best[s][0] + int(costs[4 * s + t]), best[s][1] + audits[4 * s + t], s) for s in range(4) if best[s] and costs[4 * s + t] >= 0] for t in range(4)]
            chosen = [min(o) if o else None for o in offers]
            best = [c and c[:2] for c in chosen]
            choices.append([c and c[2] for c in chosen])
        cost, audit, state = min((*best[s], s) for s in (NOTHING, ASSISTANT) if best[s])
        begins, pieces = [], []
        for chosen, audits in zip(reversed(choices), reversed(rows["audits"].tolist()), strict=True):
            begins.append(chosen[state])
            pieces.append(audits[4 * chosen[state] + state])
            state = chosen[state]
        timed = rows.dropna(subset=["least"])
        least, greatest = timed["least"].astype("int64").tolist(), timed["greatest"].astype("int64").tolist()
        known = int(timed["known"].sum()) - sum(a == b for a, b in zip(greatest, least[1:], strict=False))
        ends = [e for one in rows["ends"] for e in (one[:1], one[-1:]) if len(one)]
        joints = [(a[0], b[0]) for a, b in zip(ends[1::2], ends[2::2], strict=False)]
        illegal = int(rows["illegal"].sum()) + sum(wrong_pairs(j) for j in joints)
        one = {"gaps": greatest[-1] - least[0] + 1 - known if least else 0, **{c: int(rows[c].sum()) for c in counts[:3]}, "illegal": illegal, "cost": cost}
        first = [True] + [False] * (len(rows) - 1)
        return pd.DataFrame({"conv": rows["conv"], "at": rows["at"], "begin": begins[::-1], "piece": pieces[::-1], **one, "audit": [audit if f else None for f in first]})

    facts = told.select("conv", "at", summed("turn", "role", "text", "earlier").alias("_s")).select("conv", "at", "_s.*")
    numbers = ", ".join(f"{c} long" for c in ("gaps", *counts, "cost"))
    plan = cut(facts.groupBy("conv").applyInPandas(composed, f"conv long, at long, begin int, piece string, {numbers}, audit string"))

    @F.pandas_udf("string")
    def body(roles: pd.Series, texts: pd.Series, begin: pd.Series, piece: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(lines(p, r, x, b)) for r, x, b, p in zip(roles, texts, begin, piece, strict=True)])

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, whole, any_ = None, None, False
        for frame in frames:
            for name, text in zip(frame["name"], frame["body"], strict=True):
                if name != last:
                    if last is not None:
                        yield pd.DataFrame({"name": [last], "repaired_sha256": [whole.hexdigest()]})
                    last, whole, any_ = name, hashlib.sha256(), False
                if text:  # a segment without turns has none
                    whole.update((("\n" if any_ else "") + text).encode("utf-8", "surrogatepass"))
                    any_ = True
        if last is not None:
            yield pd.DataFrame({"name": [last], "repaired_sha256": [whole.hexdigest()]})

    both = held.alias("h").join(plan.alias("p"), F.col("h.conv").eqNullSafe(F.col("p.conv")) & (F.col("h.at") == F.col("p.at")))
    bodies = both.select(_name("h.conv"), F.col("h.at").alias("at"), body("h.role", "h.text", "begin", "piece").alias("body"))
    digests = bodies.repartition("name").sortWithinPartitions("name", "at").mapInPandas(hashed, "name string, repaired_sha256 string")
    named = plan.where("at = 0").select("conv", _name("conv"), "gaps", *counts, "cost", "audit")
    return named.join(digests, "name").drop("name")


def _name(conv: str) -> Column:
    return F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("name")


def repair(table: DataFrame) -> DataFrame:
    """conv_id and the results of the repair of a table (conv_id, turn, role, text) after its damage.

    A null role or text is one space, and so is a null id or turn where damage is drawn; rows without conv_id are one
    conversation. Turns go by number, null first, equal ones by role and the digest of the text. Repeated rows are turns that
    repeat. A conversation whose rows are all dropped has zeros, no audit, and the hash of an empty string; an empty table
    has no rows. Texts of any length are taken whole. Other columns are not read.
    """
    return repaired(damaged(rows_of(table, null=" "))).withColumnRenamed("conv", "conv_id")
