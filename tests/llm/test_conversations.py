"""The prefix trie and the structure repair against plain versions, on odd rows and the small tables."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from sifter.llm import prefix_trie as trie
from sifter.llm.prefix_trie import prefix_trie
from sifter.llm.structure_repair import audits, repaired_turns, structure_repair

SF = "/root/testdata/sf0.001"
#: conversations with columns whose names clash with those used inside
SCHEMA = "conv_id long, turn long, role string, text string, audit string, depth int, members string, k1 string, dropped int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "m", "k", 0) for r in rows], SCHEMA)


def odd_rows():
    rng = random.Random(3)
    rows = [
        (0, 0, "system", "A. b!"), (0, None, "user", "first"), (0, 1, None, None), (0, 1, "user", ""), (0, 9, "assistant", "x" * 50_000 + "."),
        (None, 0, "user", "no id."), (None, None, None, None), (7, 3, "user", " \t\n"), (8, 2, "", "."), (9, 5, "tool", "é…?"),
        (-3, 0, "user", "below zero."), (-5, 0, "user", "below zero."), (-5, 1, "assistant", "yes."), (11, 4, "user", "q?"), (11, 4, "user", "q?"),
    ]
    for c in itertools.chain(range(20, 60), range(1000, 1020)):
        for t in range(rng.randrange(1, 13)):
            text = rng.choice(["", "Yes.", "No!", "and", "a b c?", "Hm. ", ".", f"own {c}."])
            rows.append((c, rng.choice([t, t, t, t, t + 3, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None]), text))
    for c in (70, 71, 72, 75):  # long ones that share most turns
        rows += [(c, t, "ua"[t % 2], f"turn {t}." if t < 190 or c == 75 else f"{c} alone.") for t in range(200 + c - 70)]
    return rows + rows[:3]


def md5(*parts):
    return hashlib.md5("".join(parts).encode()).hexdigest()


def first_null(turn):
    return turn is not None, turn or 0


def plain_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((first_null(t), role, md5(str(len(role.encode())), ":", role, text), text))
    own = {c: [(x[1], x[3]) for x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
            if d:
                children[paths[c][: d - 1]].add(paths[c][:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[x] for x in children[node])
    for node, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(paths[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        yield ids[0], len(node), parent, len(ids), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()


def plain_damage(rows):
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """(cost, audit, repaired) by uniform-cost search over (row, last role): rows are (role, must go, truncated)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, k, last, out = heapq.heappop(heap)
        if k == len(rows) and last in ("", "a"):
            return cost, audit, out
        if (k, last) in done:
            continue
        done.add((k, last))
        due = "assistant" if last == "u" else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", k, due[0], (*out, (due, None))))
        if k < len(rows):
            role, gone, cut = rows[k]
            heapq.heappush(heap, (cost + 3, audit + "D", k + 1, last, out))
            if not gone:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", k + 1, due[0], (*out, (due, k))))
                if role[:1] == due[0] or (role[:1] == "s" and last == ""):
                    heapq.heappush(heap, (cost + cut, audit + "K", k + 1, role[0], (*out, (role, k))))


def plain_repair(rows):
    damaged = defaultdict(list)
    for c, t, role, text in plain_damage(rows):
        damaged[c].append((first_null(t), role, md5(text), text, t))
    for c in {r[0] for r in rows}:
        own = sorted(damaged[c], key=lambda x: x[:3])
        turns = {x[4] for x in own if x[4] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, marked, counts = set(), [], [0, 0, 0]
        for _, role, _, text, _ in own:
            blank = not re.search(r"[^\x20\x09-\x0d]", text)
            again, cut = (role, text) in seen, not re.search(r"[.!?][\x20\x09-\x0d]*\Z", text)
            seen.add((role, text))
            counts[0] += blank
            counts[1] += again and not blank
            counts[2] += cut and not again and not blank
            marked.append((role, blank or again, cut and not blank and not again))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, out = cheapest(marked)
        body = "\n".join(f"{role}:{'' if k is None else own[k][3]}" for role, k in out)
        yield (c, gaps, *counts, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest()), [(r, "" if k is None else own[k][3]) for r, k in out]


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
REPAIR = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def small(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]


def test_trie_against_plain_version(spark):
    for rows in (small(spark), odd_rows()):
        assert rows_of(prefix_trie(table(spark, rows)), TRIE) == sorted(plain_trie(rows), key=repr)


def test_trie_of_many_small_shards(spark):
    rows = odd_rows()
    shards = trie.shard_nodes(trie.rebuilt_turns(table(spark, rows)), 7, 5)
    assert shards.groupBy(*trie.KEY).count().where("count > 1").count() > 10
    assert rows_of(prefix_trie(table(spark, rows), 7, 5), TRIE) == sorted(plain_trie(rows), key=repr)


def test_shard_against_sets():
    rng = random.Random(5)
    shard = trie._Shard(0)
    convs = [[rng.choice("ab") for _ in range(rng.randrange(6))] for _ in range(300)]
    for c, turns in enumerate(convs):
        shard.add((c, len(turns), 0, 0), [(t, 1, hash((k, t)), hash((t, k))) for k, t in enumerate(turns)])
    want = defaultdict(list)
    for c, turns in enumerate(convs):
        for d in range(len(turns) + 1):
            want[tuple(turns[:d])].append(c)
    got = [(x[0], tuple(x[8]), tuple(x[9])) for x in shard.nodes()]
    assert sorted(got) == sorted((len(p), tuple(m), tuple(c for c in m if len(convs[c]) == len(p))) for p, m in want.items())


def test_empty_tables(spark):
    none = table(spark, [])
    assert prefix_trie(none).collect() == [] and structure_repair(none).collect() == [] and repaired_turns(none).collect() == []
    no_id = table(spark, [(None, 0, "user", "x.")])
    assert prefix_trie(no_id).collect() == [] and structure_repair(no_id).count() == 1


def test_repair_against_plain_version(spark):
    for rows in (small(spark), odd_rows()):
        want = list(plain_repair(rows))
        assert rows_of(structure_repair(table(spark, rows)), REPAIR) == sorted((w for w, _ in want), key=repr)
        turns = defaultdict(dict)
        for r in repaired_turns(table(spark, rows)).collect():
            turns[r.conv_id][r.position] = (r.role, r.text)
        for (c, *_), out in want:
            assert [turns[c][k] for k in range(len(turns[c]))] == out


@pytest.mark.parametrize("length", range(6))
def test_audits_are_the_cheapest_and_least(length):
    marks = {"X": ("user", True, False)} | {x: (x.lower(), False, x.isupper()) for x in "suaoSUAO"}
    signatures = ["".join(x) for x in itertools.product("XsuaoU", repeat=length)]
    rng = random.Random(length)
    signatures = sorted(rng.sample(signatures, min(len(signatures), 600)), key=lambda s: s[::-1])
    for signature, (cost, audit) in zip(signatures, audits(signatures)):
        assert (cost, audit) == cheapest([marks[x] for x in signature])[:2], signature
