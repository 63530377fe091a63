import hashlib
import random
import zlib

import pytest

from millwatch.llm import on_conversations, trie
from texts import words

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, code int, n bigint, tags string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, 2, "t") for r in rows], SCHEMA)


def sequences(rows):
    """Turns of every conversation; ties of a turn in the order of their hashes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, code, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}


def exchanged(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(convs):
    """All nodes from their definition."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children, out = {}, []
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    sums = {}
    for path in sorted(nodes, key=len, reverse=True):
        below = [sums[p] for p in children.get(path, [])]
        own = (len(nodes[path]) - 1) * len(words(path[-1][1])) if path else 0
        sums[path] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append(
            (min(members), len(path), parent, len(members), len(children.get(path, [])), *sums[path],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def shared_rows(seed, n, longest, letters):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(longest + 1) or 1):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", " ".join(rng.choices("ab", k=1 + (rng.random() < letters)))))
    return rows


@pytest.mark.parametrize(("block", "fan", "chunk"), [(4096, 32, 20_000), (2, 2, 3), (1, 3, 1), (3, 2, 7)])
def test_against_brute_force(spark, monkeypatch, block, fan, chunk):
    rows = shared_rows(block, 70, 7, 0.3)
    rows += [(1000 + i, t, "user", "same") for i in range(25) for t in range(5)]  # one group of copies
    rows += [(2000, t, "user", "same") for t in range(11)]  # one long conversation
    rng = random.Random(1)
    rng.shuffle(rows)
    spread = frame(spark, rows).repartition(9)
    monkeypatch.setattr(trie, "CHUNK_ROWS", chunk)
    placed = trie.steps(spread).withColumnRenamed("pos", "depth")
    found = trie.nodes(placed, placed.select("conv_id").distinct(), block=block, fan=fan)
    assert got(found) == brute(sequences(rows))


@pytest.mark.parametrize("chunk", [2, 5])
def test_chunks_of_a_task(chunk):
    """Folding sorted paths piece by piece gives the nodes of folding all at once."""
    convs = exchanged(sequences(shared_rows(5, 60, 6, 0.2)))
    code = lambda t: hashlib.md5(repr(t).encode()).digest()
    items = [
        {"s1": 0, "s2": 0, "key": b"".join(map(code, turns)), "words": [len(words(t[1])) for t in turns], "tag": c,
         "adds": [{"depth": len(turns), "n": 1, "leaves": 0, "saved": 0, "children": 0, "least": c, "ender": c, "tags": []}]}
        for c, turns in convs.items()
    ]
    items.sort(key=lambda i: (i["key"], i["tag"]))
    whole = trie.fold(items, 0, closing=True)
    held, nodes, named = [], [], {}
    for at in range(0, len(items), chunk):
        out = trie.fold(held + items[at : at + chunk], 0, closing=False)
        nodes, held = nodes + out.nodes, out.paths
        named |= {(n[3], n[1]): n[0] for n in out.named}
    out = trie.fold(held, 0, closing=True)
    nodes += out.nodes
    named |= {(n[3], n[1]): n[0] for n in out.named}
    for n in nodes:
        if n[3] is not None:
            n[2], n[3] = named[n[3], n[1] - 1], None
    assert sorted(map(str, nodes)) == sorted(map(str, whole.nodes))


def test_exchange_of_first_turns(spark):
    rows = shared_rows(3, 90, 6, 0.1)
    rows = [r for r in rows if r[0] not in (20, 40)]  # two absent sources
    found = trie.nodes(*on_conversations.rebuilt(trie.steps(frame(spark, rows))))
    assert got(found) == brute(exchanged(sequences(rows)))


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost"), (0, None, "user", "first"), (0, 0, None, None), (0, 0, "", ""), (0, 1, "u", "x " * 5000),
        (21, 5, "user", "only turn"), (7, 1, "a", "tie one"), (7, 1, "a", "tie two"), (7, 1, "a", "tie one"), (-5, 0, "é", "\u0085 y"),
        (8, 1, "ab", "c"), (9, 1, "a", "bc"),
    ]
    convs = sequences(rows)
    assert got(trie.prefix_trie(frame(spark, rows))) == brute(convs)
    exact = {c: convs.get(c - c % 20, [])[: zlib.crc32(str(c).encode()) % 4] + t[zlib.crc32(str(c).encode()) % 4 :] for c, t in convs.items() if c >= 0}
    found = trie.nodes(*on_conversations.rebuilt(trie.steps(frame(spark, [r for r in rows if r[0] != -5]))))
    assert got(found) == brute(exact)
    assert trie.prefix_trie(frame(spark, rows[:1])).collect() == []
    assert on_conversations.rebuilt(trie.steps(frame(spark, rows[:1])))[1].count() == 0
