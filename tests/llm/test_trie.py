"""Prefix trie against dictionaries of whole prefixes."""

import hashlib
import zlib

from driftwood.llm import trie
from driftwood.llm.queries import op12_trie
from llm_helpers import SF_MID, SF_SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rows):
    out = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) or 1
        saved[path] = sum(saved[p] for p in below) + ((len(nodes[path]) - 1) * len(path[-1][1].encode()) if path else 0)
    out = []
    for path, members in nodes.items():
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children.get(path, [])), leaves[path], saved[path],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def check(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    assert found(trie.prefix_trie(df)) == brute(conversations(rows))
    got = found(trie.rebuilt_trie(df))
    assert got == brute(rebuilt(conversations(rows)))
    return got


def test_shared_prefixes_ends_inside_and_copies(spark, rng):
    rows = []
    for c in range(90):
        n = rng.randrange(1, 12)
        rows += [(c, t, "user" if t % 2 else "assistant", rng.choice(["a", "bé"]) if t < 6 else f"{c % 17} {t}") for t in range(n)]
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(10)]  # copies
    rows += [(c, t, "user", "grows") for c in range(300, 315) for t in range(c - 298)]  # each the beginning of the next
    check(spark, rows)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(5, 0, None, None, "k"), (5, None, "user", "first", "k"), (5, 1, "b", "2", "k"), (5, 1, "a", "9", "k"), (5, 1, "a", "1", "k"), (5, 1, "a", "1", "k"),
            (None, 0, "user", "lost", "k"), (-7, 0, "user", "neg", "k"), (-5, 0, "user", "x", "k"), (-5, 1, "user", "y", "k"),
            (6, 0, "ab", "c", "k"), (7, 0, "a", "bc", "k"), (8, 0, "", "", "k"), (9, 0, "1:", "", "k"), (10, 0, "", "1:", "k"), (9223372036854775807, 0, "u", "z", "k")]
    check(spark, rows, SCHEMA + ", keys string")


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(1, 0, "user", "only"), (2, 0, "user", "only")]  # their group has no first conversation
    assert all(zlib.crc32(str(c).encode()) % 9 > 0 for c in (1, 2))
    got = check(spark, rows)
    assert got == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,2").hexdigest())]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(trie.prefix_trie(df)) == [] == found(trie.rebuilt_trie(df))


def test_long_conversations_take_few_rounds(spark, monkeypatch):
    rows = [(c, t, "user", f"{c} {t}" if t else "hello") for c in (0, 100, 200) for t in range(700)] + [(300, 0, "user", "x" * 3_000_000)]
    rounds = []
    real = trie.staged
    monkeypatch.setattr(trie, "staged", lambda df, name: (rounds.append(name), real(df, name))[1])
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(conversations(rows))
    assert rounds.count("trie-level") == 2


def test_many_ends_at_one_node(spark):
    rows = [(c * 1500, 0, "user", "hi") for c in range(9000)]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(conversations(rows))


def test_query(spark):
    for sf in (SF_SMALL, SF_MID):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert found(op12_trie(spark, sf)) == brute(rebuilt(conversations(rows)))
