from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from clickloom.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, key string, path string, own string, depth int"


def slow(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    members, ended = defaultdict(list), defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (abs(conv) % 5) * (1 if conv >= 0 else -1)
        path = [t[2:] for t in sorted(own.get(base, []))[:h] + sorted(turns)[h:]]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
        ended[tuple(path)].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, spared = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        size = len(node[-1][1].encode()) if node else 0
        spared[node] = (len(members[node]) - 1) * size + sum(spared[c] for c in children[node])
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(children[node]), leaves[node], spared[node],
            hashlib.sha256(",".join(map(str, sorted(ended[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], TURNS).repartition(3)
    got = prefix_trie.prefix_trie(frame).drop("key").collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == slow(rows)


def test_against_brute_force(spark):
    random.seed(3)
    rows = []
    for conv in [*range(-7, 120), *range(5000, 14000, 37)]:
        for turn in range(random.choice([0, 1, 2, 3, 7, 12])):
            rows.append((conv, random.choice([turn, turn, None]), random.choice(["user", "assistant", None]), random.choice(["a", "é", "", None, "b c"])))
    rows += [r for r in rows if r[0] % 11 == 0] + [(None, 0, "user", "x")] * 3
    rows += [(c, t, "user", f"same {t}") for c in range(20_000, 29_000, 5) for t in range(2)]  # one large group of copies
    rows += [(40_000, t, "user", f"long {t}") for t in range(700)] + [(40_001, 0, "user", "q" * 100_000)]
    check(spark, rows)


def test_odd_rows(spark):
    check(spark, [(1, None, None, None)])
    check(spark, [(0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "assistant", "a"), (3, 0, "user", "b")])
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(empty).count() == 0


def test_any_cut_into_shards_gives_the_same_trie():
    """Two shards, summed at their edges, agree with one."""
    random.seed(4)
    paths = sorted(b"".join(bytes([random.choice(b"abc")]) * 16 for _ in range(random.randint(0, 5))) for _ in range(60))
    convs = [(p, [3] * (len(p) // 16), i) for i, p in enumerate(paths)]
    whole = list(prefix_trie.time_forward([(*n[:6], False) for n in order(prefix_trie.shard_nodes(convs))]))
    for at in (0, 1, 17, 30, 60):
        done, shares = [], {}
        for shard in (convs[:at], convs[at:]):
            for row in prefix_trie.time_forward(order(prefix_trie.shard_nodes(shard))):
                if not row[6]:
                    done.append(row)
                    continue
                depth, key, parent, conv, n, size, _, *known = row
                old = shares.get(key)
                if old:
                    conv, n, known = min(conv, old[3]), n + old[4], [a + b for a, b in zip(known, old[7:], strict=True)]
                shares[key] = (depth, key, parent, conv, n, size, False, *known)
        done += prefix_trie.time_forward(order(shares.values()))
        assert sorted(done, key=lambda r: r[1]) == sorted(whole, key=lambda r: r[1])


def order(nodes):
    return sorted(nodes, key=lambda n: (-n[0], n[1]))


def test_a_spilling_queue_loses_nothing():
    random.seed(5)
    queue, sent = prefix_trie.SpillingQueue(limit=50), [(random.randint(0, 40), random.randint(0, 9), i) for i in range(2000)]
    for item in sent:
        queue.push(item)
    assert len(queue.runs) == 39
    got = [item for a in range(41) for b in range(10) for item in sorted(queue.pop_all((a, b)))]
    assert got == sorted(sent) and not queue.heap and not queue.runs
