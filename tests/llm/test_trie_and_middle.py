"""Conversation trie and fill-in-middle against brute force, hard and empty tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from crawlstats.llm import conversation_trie as ct
from crawlstats.llm import fill_in_middle as fim
from crawlstats.llm.common import fold


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- conversation trie -------------------------------------------------------


def brute_nodes(convs):
    """{sequence prefix: row} by enumeration; ``convs`` maps id to a list of (key, words)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        out = [p]
        for q in children[p]:
            out += below(q)
        return out

    rows = []
    for p, m in members.items():
        tree = below(p)
        saved = sum((len(members[q]) - 1) * (q[-1][1] if q else 0) for q in tree)
        up = min(members[p[:-1]]) if p else None
        e = sha(",".join(map(str, sorted(ends[p])))) if p in ends else sha("")
        rows.append((min(m), len(p), up, len(m), len(children[p]), sum(not children[q] for q in tree), saved, e))
    return sorted(rows, key=str)


def random_conversations(rng, n):
    shared = [[(rng.randrange(3), rng.randrange(4)) for _ in range(rng.randrange(12))] for _ in range(5)]
    out = {}
    for c in rng.sample(range(10 * n), n):
        seq = rng.choice(shared)[: rng.randrange(13)] + [(rng.randrange(2), 1) for _ in range(rng.randrange(4))]
        out[c] = [(k, (k * 7 + w) % 5) for k, w in seq]
    return out


def elements(convs):
    same = defaultdict(list)
    for c, seq in convs.items():
        same[tuple(seq)].append(c)
    symbol = lambda t: hashlib.sha256(repr(t).encode()).digest()[: ct.SYMBOL]
    found = []
    for seq, ids in same.items():
        ids = sorted(ids)
        mark = ct.Mark(len(ids), ids[0], sha(",".join(map(str, ids))))
        found.append(ct.Element(b"".join(map(symbol, seq)), np.array([w for _, w in seq], dtype=np.int32), {len(seq): mark}))
    return sorted(found, key=lambda e: e.path)


def named(batches):
    rows = [r for b in batches for r in b.to_pylist()]
    by_key = {r["key"]: r["conv_id"] for r in rows if r["key"]}
    assert len(by_key) == sum(r["key"] is not None for r in rows)
    for r in rows:
        if r["parent_key"]:
            r["parent_conv_id"] = by_key[r["parent_key"]]
    columns = [c for c in ct.NODE if c not in ("key", "parent_key")]
    return sorted((tuple(r[c] for c in columns) for r in rows), key=str)


@pytest.mark.parametrize("seed", range(60))
def test_contracted_forests_give_the_whole_trie(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(ct, "RUN_BYTES", rng.choice([1, 1500, 4000, 1 << 20]))
    monkeypatch.setattr(ct, "GROUP", rng.choice([2, 3, 64]))
    convs = random_conversations(rng, rng.choice([1, 2, 30, 120]))
    es = elements(convs)
    cuts = sorted(rng.randrange(len(es) + 1) for _ in range(rng.randrange(9)))
    parts = [es[a:b] for a, b in zip([0, *cuts], [*cuts, len(es)])]
    batches = []
    while True:  # the rounds of ``trie``, without Spark
        last, after = len(parts) == 1, []
        for p in parts:
            *nodes, rest = ct._contract(ct.Forest(), p, last)
            batches += nodes
            after.append(rest)
        if last:
            break
        parts = [sum(after[i : i + ct.GROUP], []) for i in range(0, len(after), ct.GROUP)]
    assert named(batches) == brute_nodes(convs)


def rebuilt(rows):
    """{id: [((role, text), words)]} of (conv_id, turn, role, text), as the query's contract says."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    word = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    own = {c: [((r, t), word(t)) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + seq[h:]
    return out


def spark_nodes(convs_df):
    got = ct.trie(ct.with_heads(ct.conversations(convs_df), 20, fold("conv_id", 4))).collect()
    return sorted((tuple(r) for r in got), key=str)


def test_trie_of_a_table_with_hard_rows(spark):
    rng = random.Random(5)
    rows = []
    for c in range(0, 400):
        if c in (20, 40):
            continue  # families without their first conversation
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a b", "same  text\n here", "x " * 3])))
    rows += [(500, None, None, None), (500, 1, "user", "a " * 50_000), (501, None, "user", "é\x1cw")]
    rows += [(600 + i, t, "user", f"copy {t}") for i in range(150) for t in range(4)]  # many equal conversations
    rows += [(900, t, "user", f"long {t % 7}") for t in range(3000)] + [(920, t, "user", f"long {t % 7}") for t in range(2500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'clash' as path", "'clash' as turns", "1 as words", "2 as depth", "3 as part").repartition(7)
    want = brute_nodes_deep(rebuilt(rows))
    assert spark_nodes(df) == want
    ranged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:  # as many forests as partitions
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert spark_nodes(df) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", ranged)
    assert spark_nodes(df.where("false")) == []
    none = spark.createDataFrame([(None, 1, "user", "t")], df.select("conv_id", "turn", "role", "text").schema)
    assert spark_nodes(none) == []


def brute_nodes_deep(convs):
    """As ``brute_nodes``, for long conversations: prefixes by chained hashes, sums from the deepest up."""
    info = {}
    for c, seq in convs.items():
        key = ""
        info.setdefault(key, {"m": [], "e": [], "up": None, "w": 0, "d": 0})["m"].append(c)
        for d, (turn, w) in enumerate(seq, 1):
            up, key = key, sha(key + repr(turn))
            info.setdefault(key, {"m": [], "e": [], "up": up, "w": w, "d": d})["m"].append(c)
        info[key]["e"].append(c)
    for v in info.values():
        v["children"], v["leaves"], v["saved"] = 0, 0, (len(v["m"]) - 1) * v["w"]
    for v in sorted(info.values(), key=lambda v: -v["d"]):
        v["leaves"] = v["leaves"] or 1
        if v["up"] is not None:
            u = info[v["up"]]
            u["children"] += 1
            u["leaves"] += v["leaves"]
            u["saved"] += v["saved"]
    return sorted(
        (
            (min(v["m"]), v["d"], None if v["up"] is None else min(info[v["up"]]["m"]), len(v["m"]), v["children"], v["leaves"], v["saved"], sha(",".join(map(str, sorted(v["e"])))))
            for v in info.values()
        ),
        key=str,
    )


def test_lcp_counts_turns():
    a, b = b"a" * 16, b"b" * 16
    assert [ct.lcp(x, y) for x, y in [(b"", b""), (a, b""), (a, b), (a + b, a), (a + b, a + b), (a * 9 + b, a * 9 + a)]] == [0, 0, 0, 1, 2, 9]


# --- fill in middle ----------------------------------------------------------


def test_skip_list_places_every_rank():
    rng = random.Random(1)
    for n in [0, 1, 3, 4, 5, 16, 17, 63, 64, 65, 1000]:
        widths = [rng.randrange(1, 9) for _ in range(n)]
        index = fim.SkipList(widths)
        assert len(index) == n
        assert [index.place(r) for r in range(n + 1)] == [sum(widths[:r]) for r in range(n + 1)]
        assert all(sum(u) == n and sum(w) == sum(widths) for u, w in index.lanes)


def test_lines_match_the_pattern():
    for t in ["", "\n", "a", "a\n", "\n\na", "a\r\nb\x0bc d", "\x1c\n\x85"]:
        assert fim.lines(t) == re.findall(r"[^\n]*\n|[^\n]+", t)


def brute_middle(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    u = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(u)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 100:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (u[:a], u[a:b], u[b:]))
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, form, len(p), len(m), sha(out), sha(text))


def test_fill_in_middle_rebuilds_every_text(spark, hard_documents, no_documents):
    extra = [(1000 + i, t) for i, t in enumerate(["\n" * 5000, "a\nb <P> c", "<S>", "<<S\n<P\n<", "😀\nß\n" * 99, "no line feed", "<M\n>", "x\n" * 100_000])]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    docs = hard_documents.unionByName(more, allowMissingColumns=True)
    made = fim.fill_in_middle(docs)
    got = made.selectExpr("doc_id", "n", "form", "prefix_chars", "middle_chars", "sha2(cast(output as binary), 256)").withColumn("r", fim.F.lit("")).collect()
    whole = made.select("doc_id", fim.F.sha2(fim.restored().cast("binary"), 256).alias("r")).collect()
    want = sorted((brute_middle(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted((tuple(a)[:6] + (b.r,) for a, b in zip(got, whole)), key=str) == want
    assert fim.fill_in_middle(no_documents).collect() == []
    plain = fim.fill_in_middle(docs, rate=0).where("form <> 'plain'")
    assert plain.count() == 0
    assert {r.form for r in fim.fill_in_middle(docs, spm=100).collect()} == {"plain", "spm"}
