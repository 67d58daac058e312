"""Conversation prefix trie against a dictionary of prefixes."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from custvalue.llm.prefix_trie import (Encoded, conversation_trie, findclose, prefix_trie, rebased, turn_sequences)

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebase=True):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is None:
            continue
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        convs.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    convs = {k: [x[3] for x in sorted(v)] for k, v in convs.items()}
    members, kids = {}, {}
    length = {}
    for k, v in convs.items():
        h = zlib.crc32(str(k).encode()) % 4 if rebase else 0
        v = convs.get(k - k % 20, [])[:h] + v[h:]
        length[k] = len(v)
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(k)
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * words
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(kids.get(node, [])),
                   leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(k for k in m if length[k] == len(node)))).encode()).hexdigest())
                  for node, m in members.items())


def check(df, rebase=True):
    if rebase:
        head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
        trie = prefix_trie(rebased(turn_sequences(df), 20, head, 3))
    else:
        trie = conversation_trie(df)
    got = sorted(tuple(-1 if x is None else x for x in r) for r in trie.select(*COLUMNS).collect())
    assert got == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()], rebase)
    return got


def closes(bits):
    stack, out = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            out[stack.pop()] = i
    return [out[i] for i in sorted(out)]


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 500, 4000])
@pytest.mark.parametrize("opening", [0.2, 0.5, 0.9])
def test_findclose(n, opening):
    rnd, bits, depth, left = random.Random(n), [], 0, n
    while left or depth:
        if left and (not depth or rnd.random() < opening):
            bits, depth, left = bits + [1], depth + 1, left - 1
        else:
            bits, depth = bits + [0], depth - 1
    a = np.array(bits, np.uint8)
    assert findclose(a, np.flatnonzero(a)).tolist() == closes(bits)


def test_encoding():
    a, b = b"a" * 16, b"b" * 16
    e = Encoded([b"", a, a + b, a + b, b], [[], [1], [1, 2], [1, 2], [3]])
    assert e.bits.tolist() == [1, 1, 1, 0, 0, 1, 0, 0]
    assert e.subtree_sum(e.count).tolist() == [5, 3, 2, 1]
    assert e.leaves(None).tolist() == [2, 1, 1, 1]


def test_conversations(spark, sf):
    check(spark.read.parquet(f"{sf}/conversations.parquet"))
    check(spark.read.parquet(f"{sf}/conversations.parquet"), rebase=False)


def test_empty(spark):
    assert check(spark.createDataFrame([], SCHEMA)) == []


def test_odd_rows(spark):
    long = "w " * 50_000
    rows = [(1, 0, "u", "a"), (1, None, None, None), (1, 0, "u", "a"), (None, 1, "x", "y"), (25, 0, "u", "q"),
            (20, 0, "u", long), (20, 1, "a", "k"), (40, 0, "", ""), (41, 3, "u", " \n\t"), (-5, 0, "u", "neg"),
            (61, 1, "1:u", "a"), (62, 1, "1", ":ua")]
    extra = [(*r, b"x", 7, "y") for r in rows]
    check(spark.createDataFrame(extra, SCHEMA + ", key binary, shard int, path string"))


def test_hot_turns_copies_and_long_conversations(spark):
    rnd, rows = random.Random(3), []
    for c in range(2400):
        if c % 3 == 0:
            seq = ["hot one", "hot two", "hot", "end"]
        elif c % 100 == 1:
            seq = ["x"] * 300
        else:
            seq = [rnd.choice(["hot one", "b c", "d"]) for _ in range(rnd.choice([1, 2, 3, 8]))]
        rows += [(c, t, "u" if t % 2 == 0 else "b", x) for t, x in enumerate(seq)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check(df)
    check(df, rebase=False)


def test_one_turnless_and_one_lone(spark):
    got = check(spark.createDataFrame([(c, 0, "u", f"t{c}") for c in range(1, 20)], SCHEMA))
    assert got[0][3] == 19
