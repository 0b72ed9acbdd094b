"""The prefix trie of rebuilt conversations against a trie of dictionaries."""
import hashlib
import random
import zlib
from collections import defaultdict
from dataclasses import dataclass, field

from coclick.llm import prefixtrie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth long, k1 long, pos long, base string"


@dataclass
class Node:
    depth: int
    size: int
    parent: "Node | None"
    children: dict = field(default_factory=dict)
    members: list = field(default_factory=list)
    ends: list = field(default_factory=list)


def trie_by_hand(rows):
    """Nodes of ``rows(conv_id, turn, role, text)``; ties in a turn number must be equal rows."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0))
    root = Node(0, 0, None)
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 9
        node = root
        node.members.append(c)
        for _, role, text in convs.get(c - c % 5, [])[:h] + convs[c][h:]:
            node = node.children.setdefault((role, text), Node(node.depth + 1, len(text.encode()), node))
            node.members.append(c)
        node.ends.append(c)
    order = [root] if convs else []
    for node in order:
        order.extend(node.children.values())
    total = {}
    for node in reversed(order):
        below = [total[id(x)] for x in node.children.values()]
        total[id(node)] = (sum(b[0] for b in below) if below else 1,
                           (len(node.members) - 1) * node.size + sum(b[1] for b in below))
    return sorted((n.members[0], n.depth, n.parent.members[0] if n.parent else None, len(n.members), len(n.children),
                   *total[id(n)], hashlib.sha256(",".join(map(str, n.ends)).encode()).hexdigest()) for n in order)


def trie(df, **kw):
    return sorted(tuple(r) for r in T.prefix_trie(df, **kw).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def key(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


def messy_turns():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", None, ""]))
            for c in [*range(60), -7, -5, 2 ** 62] for t in range(rng.randint(1, 12))]
    # a conversation of 700 turns, copied, and its family; nulls in every column; repeated rows
    rows += [(c, t, "user", f"t{t % 50}") for c in (100, 101, 103, 106) for t in range(700 if c < 106 else 70)]
    rows += [(120, None, "user", "first"), (120, 0, "user", "second"), (None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(121, 3, "user", "twice")] * 2 + [(122, 1, "x" * 50, "long " * 20_000)]
    rng.shuffle(rows)
    return rows


def with_more(rows):
    return [(*r, 1, 2, 3, "clash") for r in rows]


def test_trie_equals_brute_force(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert key(trie(given)) == key(trie_by_hand(map(tuple, given.collect())))


def test_trie_of_messy_turns_in_bands_of_any_height(spark):
    df = spark.createDataFrame(with_more(messy_turns()), SCHEMA).repartition(5)
    want = key(trie_by_hand(messy_turns()))
    assert max(r[1] for r in want) >= 700
    assert key(trie(df)) == want
    assert key(trie(df, band=3)) == want


def test_turnless_conversations_and_empty_tables(spark):
    # alone in their families with at most h turns: rebuilt without any
    ids = [c for c in range(200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:6]
    rows = [(c, 0, "user", "hello") for c in ids]
    got = trie(spark.createDataFrame(with_more(rows), SCHEMA))
    assert got == trie_by_hand(rows) and len(got) == 1 and got[0][4:7] == (0, 1, 0)
    assert trie(spark.createDataFrame([], SCHEMA)) == []


def test_ends_of_a_node_are_hashed_over_many_chunks(spark):
    ends = spark.range(-50, 150).selectExpr("1L as depth", "id % 2 as k1", "9L as k2", "id as conv_id")
    got = {r["k1"]: r["ends_sha256"] for r in T._end_digests(ends, 7).collect()}
    for k in (-1, 0, 1):
        ids = [i for i in range(-50, 150) if (i % 2 if i >= 0 else -(-i % 2)) == k]
        assert got[k] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
