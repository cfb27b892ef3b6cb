"""The prefix trie against a plain one, on odd rows and on conversations of many blocks."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ionweave.llm import prefixtrie
from ionweave.llm import queries as q

KIND = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def turn_id(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def rebuilt(rows, branch=True):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, turn_id(role or "", text or ""), role or "", text or ""))
    plain = {c: [t[3:] for t in sorted(x)] for c, x in convs.items()}
    if not branch:
        return plain
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in plain}
    return {c: plain.get(c - int(c % 100 if c >= 0 else -(-c % 100)), [])[: heads[c]] + plain[c][heads[c] :] for c in plain}


def plain_trie(paths):
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    out = []
    for node, m in members.items():
        under = [u for u in members if u[: len(node)] == node]
        children = [u for u in under if len(u) == len(node) + 1]
        leaves = [u for u in under if not any(w[: len(u)] == u and len(w) > len(u) for w in under)]
        saved = sum((len(members[u]) - 1) * len(u[-1][1]) for u in under if u)
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, KIND).withColumns({c: F.lit("x") for c in ("position", "block", "said", "node", "depth", "part", "run")})
    monkeypatch.setattr(q, "table", lambda *_: df)
    out = q.op13_prefix_trie(spark, "")
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=str)


def made(seed, n, longest, kinds):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "bé", "longer 漢字"][:kinds])) for c in rng.sample(range(320), n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("seed,n,longest,kinds", [(1, 60, 6, 2), (2, 80, 20, 3), (3, 30, 40, 1)])
def test_equals_a_plain_trie(spark, monkeypatch, seed, n, longest, kinds):
    rows = made(seed, n, longest, kinds)
    assert trie(spark, rows, monkeypatch) == plain_trie(rebuilt(rows))


def test_odd_rows(spark, monkeypatch):
    rows = [(None, 0, "user", "no conversation"), (7, None, None, None), (7, 1, "user", "a"), (7, 1, "user", "a"), (7, 1, "assistant", "a"), (100, 0, "user", "x"), (100, 5, None, "y"), (101, -1, "user", ""), (150, 0, "u", "x"), (3, 0, "user", "x" * 100_000), (-5, 0, "user", "x"), (-105, 0, "user", "x")]
    assert trie(spark, rows, monkeypatch) == plain_trie(rebuilt(rows))
    assert trie(spark, [], monkeypatch) == []
    # roles and texts don't run into each other
    assert trie(spark, [(0, 0, "a", "bc"), (200, 0, "ab", "c")], monkeypatch) == plain_trie(rebuilt([(0, 0, "a", "bc"), (200, 0, "ab", "c")]))


def test_long_conversations_over_many_runs(spark, monkeypatch):
    """Runs of two blocks, so that conversations of 100 turns cross several."""
    monkeypatch.setattr(prefixtrie, "RUN", 2)
    rng = random.Random(4)
    shared = [("user", rng.choice("abc")) for _ in range(100)]
    rows = []
    for c in range(20):
        cut = rng.choice([8, 16, 17, 33, 64, 100])
        rows += [(c, t, *x) for t, x in enumerate(shared[:cut] + [("assistant", rng.choice("de")) for _ in range(rng.randint(0, 30))])]
    assert trie(spark, rows, monkeypatch) == plain_trie(rebuilt(rows))


def test_a_third_of_all_conversations_alike(spark, monkeypatch):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 900, 3) for t in range(3)] + [(c, 0, "user", f"own {c}") for c in range(1, 900, 3)]
    assert trie(spark, rows, monkeypatch) == plain_trie(rebuilt(rows))


def test_turn_texts(spark):
    df = spark.createDataFrame([(0, 0, None, None), (1, 0, "", ""), (2, 0, "user", "hi"), (3, 0, "user", "hi")], KIND)
    rows = prefixtrie.turn_texts(df).collect()
    assert {(bytes(r.turn_id), r.role, r.text) for r in rows} == {(turn_id("", ""), "", ""), (turn_id("user", "hi"), "user", "hi")}
