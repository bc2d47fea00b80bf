"""op1, op9: gradients, proper probabilities, gains on held-out rows, defined cases."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF0001

from crawlstats.llm import lm_scoring as L
from crawlstats.llm import toxicity as T
from crawlstats.llm.gru import Gru, lanes, windows
from crawlstats.llm.label_model import LabelModel, fit_linear

DATA = SF0001.replace("sf0.001", "sf0.01")


# --- the network ----------------------------------------------------------------------

def loss(g, x, first, kind, place, live):
    hs = g.states(x, first, np.zeros((x.shape[1], g.hidden), np.float32))
    lp = g.log_probs(hs.reshape(-1, g.hidden), kind.ravel(), place.ravel())
    return -(lp * live.ravel()).sum(dtype=np.float64)


def test_gradients(monkeypatch):
    """Against finite differences, with documents that begin inside the window."""
    r = np.random.default_rng(0)
    g = Gru(symbols=9, classes=6, heads=2, size=3, hidden=4)
    for n in g.NAMES:
        setattr(g, n, r.standard_normal(getattr(g, n).shape) * 0.5)
    steps, n = 6, 5
    x, kind = r.integers(0, 9, (steps, n)), r.integers(0, 6, (steps, n))
    place = np.where(kind < 2, r.integers(0, 3, (steps, n)), 0)
    first = r.random((steps, n)) < 0.2
    live = (r.random((steps, n)) < 0.9).astype(np.float64)
    found = {}
    monkeypatch.setattr(Gru, "_step", staticmethod(lambda p, grad, m, rows: found.__setitem__(id(p), (grad, rows))))
    real = np.empty
    monkeypatch.setattr(np, "empty", lambda shape, dtype=float: real(shape, np.float64))
    g.learn(x, first, np.zeros((n, 4)), kind, place, live, {})
    for name in g.NAMES:
        p = getattr(g, name)
        grad, rows = found[id(p)]
        full = np.zeros_like(p)
        full[rows] = grad
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 12)]:
            was, e = p[at], 1e-5
            p[at] = was + e
            up = loss(g, x, first, kind, place, live)
            p[at] = was - e
            down = loss(g, x, first, kind, place, live)
            p[at] = was
            assert full[at] == pytest.approx((up - down) / (2 * e), abs=2e-4), (name, at)


def test_lanes_and_windows_cover_every_token():
    for length in ([5], [3, 1, 4, 1, 5, 9, 2, 6], [1] * 700, [2000, 1, 1]):
        length = np.array(length)
        order, total = lanes(length, 4)
        assert sorted(order.tolist()) == list(range(len(length))) and total.sum() == length.sum()
        seen = Counter(p for _, at, live in windows(total) for p in at[live].tolist())
        assert seen == Counter(range(int(length.sum())))


def test_scores_do_not_depend_on_lanes_or_windows(monkeypatch):
    r = np.random.default_rng(2)
    docs = [np.append(r.integers(0, L.END, n), L.END).astype(np.int16) for n in (0, 1, 700, 33, 5000, 12)]
    g = L.blank()
    g.out[:], g.tok[:] = r.standard_normal(g.out.shape) * 0.3, r.standard_normal(g.tok.shape) * 0.3
    together = L.log10_scores(g, L.Flat(docs))
    alone = np.concatenate([L.log10_scores(g, L.Flat([d])) for d in docs])
    assert together == pytest.approx(alone, rel=1e-4)


def test_scores_equal_a_pass_step_by_step():
    """One document after the other, one token after the other, in plain numbers."""
    r = np.random.default_rng(4)
    g = L.blank()
    for n in g.NAMES:
        setattr(g, n, (r.standard_normal(getattr(g, n).shape) * 0.4).astype(np.float32))
    emb, rec, out, out_bias, tok, tok_bias = (getattr(g, n).astype(np.float64) for n in g.NAMES)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    log_softmax = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    docs = [np.append(r.integers(0, L.END, n), L.END).astype(np.int16) for n in (0, 3, 40, 300)]
    n, want = g.hidden, []
    for doc in docs:
        h, before, total = np.zeros(n), L.END, 0.0
        for s in doc.tolist():
            gx, gh = emb[before], h @ rec
            z, q = sigmoid(gx[:n] + gh[:n]), sigmoid(gx[n : 2 * n] + gh[n : 2 * n])
            new = np.tanh(gx[2 * n :] + q * gh[2 * n :])
            h = (1 - z) * new + z * h
            kind = s // L.SIZE if s < L.HEAD else L.HEADS + s - L.HEAD if s < L.END else L.HEADS + L.TAILS
            total += log_softmax(h @ out + out_bias)[kind]
            if s < L.HEAD:
                own = slice(kind * L.SIZE, (kind + 1) * L.SIZE)
                total += log_softmax(tok[own] @ h + tok_bias[own])[s % L.SIZE]
            before = s
        want.append(total / math.log(10))
    assert L.log10_scores(g, L.Flat(docs)) == pytest.approx(want, rel=1e-4)


def test_words_of_a_batch():
    import pyarrow as pa

    texts = ["", " ", " A b\x0b C ", "one", "Ab\x1cÉé \u00a0 x", "...  '' .a a. \u4e2d."]
    flat, size = L.split(pa.array(texts))
    want = [t.encode().lower().split() for t in texts]
    assert size.tolist() == [len(w) for w in want]
    assert flat.cast(pa.binary()).to_pylist() == [w for ws in want for w in ws]
    words = [w for ws in want for w in ws] + [b"(.", b"x", b"xy", b"\xc3\xa9.", b"."]
    assert L.tail_classes(pa.array(words, pa.binary())).tolist() == [L.tail_class(w) for w in words]
    assert L.tail_classes(pa.array(words, pa.binary()).slice(3, 4)).tolist() == [L.tail_class(w) for w in words[3:7]]


def test_the_dictionary_is_cut_by_word(spark, monkeypatch):
    rows = [(f"w{i}".encode(), 5) for i in range(300)] + [(f"v{i}".encode(), 40 + i % 3) for i in range(30)]
    counts = spark.createDataFrame(rows, "word binary, n long")
    for bound in (10, 25, 100, 330, 1000):
        monkeypatch.setattr(L, "DICTIONARY", bound)
        got = sorted(r.n for r in counts.where(L.in_dictionary(counts)).collect())
        assert bound - 3 <= len(got) <= bound or len(got) == 330 <= bound
        assert got == sorted((n for _, n in rows), reverse=True)[: len(got)][::-1]
    assert counts.where("false").where(L.in_dictionary(counts.where("false"))).count() == 0


def test_probabilities_of_all_next_tokens_sum_to_one():
    c = Counter({f"w{i}".encode(): 3000 - i for i in range(1500)})
    kinds = {}
    for w, n in c.items():
        k = L.tail_class(w)
        kinds[k] = (kinds.get(k, (0, 0))[0] + n, kinds.get(k, (0, 0))[1] + 1)
    v = L.Vocabulary(list(c.items()), kinds, 10)
    g = v.unigram()
    h = np.random.default_rng(1).standard_normal((1, g.hidden)).astype(np.float32)
    g.out[:] = 0.2
    head = sum(math.exp(g.log_probs(h, np.array([i // L.SIZE]), np.array([i % L.SIZE]))[0]) for i in range(L.HEAD))
    by_class = {k: math.exp(g.log_probs(h, np.array([L.HEADS + k]), np.array([0]))[0]) for k in range(L.TAILS)}
    share = Counter()
    for w, i in v.index.items():
        if i >= L.HEAD:
            share[L.tail_class(w)] += 10 ** v.share[i]
    tail = sum(p * (share[k] + 0.5 / v.tail_mass[k]) for k, p in by_class.items())  # and one unknown word
    end = math.exp(g.log_probs(h, np.array([L.HEADS + L.TAILS]), np.array([0]))[0])
    assert head + tail + end == pytest.approx(1, abs=1e-5)


def test_model_has_its_whole_size():
    """1,024 frequent words are predicted one by one, from a state of 24 units."""
    c = Counter({f"w{i}".encode(): 3000 - i for i in range(1500)})
    kinds = {}
    for w, n in c.items():
        k = L.tail_class(w)
        kinds[k] = (kinds.get(k, (0, 0))[0] + n, kinds.get(k, (0, 0))[1] + 1)
    v = L.Vocabulary(list(c.items()), kinds, 10)
    assert v.symbol[:1024].tolist() == list(range(1024)) and not v.share[:1024].any()
    assert (v.symbol[1024:] >= 1024).all() and v.share[1024:].all()
    assert v.unigram().tok.shape == (1024, 24)


def base_scores(docs):
    split = {d: (t or "").encode().lower().split() for d, t in docs}
    train = [d for d in split if zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(w for d in train for w in split[d])
    n, v = sum(c.values()) + len(train), len(c) + (1 if train else 0)
    one = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    return {
        d: (d not in train, len(w) + 1, sum(c[x] > 0 for x in w) + bool(train), n, sum(one(c[x]) for x in w) + one(len(train)))
        for d, w in split.items()
    }


@pytest.mark.parametrize("dictionary", [L.DICTIONARY, 1100])
def test_lm_scores(spark, monkeypatch, dictionary):
    """The base by brute force, also where most words are rare; a gain on held-out documents."""
    monkeypatch.setattr(L, "DICTIONARY", dictionary)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = L.lm_scores(docs).collect()
    exp = base_scores([(r.doc_id, r.text) for r in docs.collect()])
    assert len(rows) == len(exp)
    for r in rows:
        held, n, known, total, base = exp[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held)
    assert sum(r.score > r.base_score for r in held) > 0.9 * len(held)


def test_lm_scores_of_hard_cases(spark, hard_documents, no_documents):
    rows = L.lm_scores(hard_documents).collect()
    assert len(rows) == hard_documents.count()
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    empty = [r for r in rows if r.n_tokens == 1]
    assert len(empty) == 4 and len({round(r.base_score, 9) for r in empty}) == 1
    assert L.lm_scores(no_documents).collect() == []
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    held = hard_documents.where("doc_id in (2, 3, 8)").selectExpr(f"cast(doc_id * 0 + {one} as bigint) doc_id", "text")  # nothing to learn from
    for r in L.lm_scores(held).collect():
        assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score)


# --- toxicity ----------------------------------------------------------------------------

def test_label_model_finds_good_and_correlated_voters():
    r = np.random.default_rng(0)
    y = r.random(4000) < 0.3
    vote = lambda acc, cover: np.where(r.random(4000) < cover, np.where(r.random(4000) < acc, 2 * y - 1, 1 - 2 * y), 0)
    good, copy, poor = vote(0.95, 0.8), None, vote(0.55, 0.9)
    copy = good.copy()
    label = np.where(r.random(4000) < 0.95, y, ~y)
    votes = np.column_stack([2 * label - 1, good, copy, poor, vote(0.85, 0.6)]).astype(np.int8)
    m = LabelModel().fit(votes, label.astype(float))
    assert m.correlation[1, 2] == pytest.approx(1) and m.weight[1] < 0.7
    acc = m.accuracies()
    assert acc[1] > acc[4] > acc[3]
    assert ((m.posterior(votes) > 0.5) == y).mean() >= (label == y).mean()


def test_linear_classifier_separates():
    feature, start = [], [0]
    target = np.array([i % 3 == 0 for i in range(300)], dtype=float)
    for i in range(300):
        feature += [0] if i % 3 == 0 else [1]
        feature += [2]
        start.append(len(feature))
    w = fit_linear(np.array(start), np.array(feature), target, 3)
    assert w[0] + w[2] + w[3] > 1 > -1 > w[1] + w[2] + w[3]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in T.toxicity(docs, labels).collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(rows[r.doc_id], r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    toxic = [r.predicted for r, y in held if y == 1]
    clean = [r.predicted for r, y in held if y == 0]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.02


def test_toxicity_reads_only_training_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "labels"))
    a = {r.doc_id: r.score for r in T.toxicity(docs, labels).collect()}
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    assert {r.doc_id: r.score for r in T.toxicity(docs, flipped).collect()} == a


def test_toxicity_of_hard_cases(spark, hard_documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (5, 0, 1), (8, 0, None), (None, 0, 1), (9, 1, 0)], "doc_id long, quality int, toxic int")
    rows = T.toxicity(hard_documents, labels).collect()
    assert len(rows) == hard_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert T.toxicity(no_documents, labels).collect() == []
    none = T.toxicity(hard_documents, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert max(r.score for r in T.toxicity(hard_documents, labels.where("toxic = 0")).collect()) < 1e-9
    left = T.non_toxic(hard_documents, labels.where("toxic = 0"))
    assert left.columns == hard_documents.columns and left.count() == hard_documents.count()


def plain_label_model(votes, start, rounds=25):
    """Posteriors of the label model, in plain loops over rows and voters."""
    n, m = len(votes), len(votes[0])
    post, weight = list(start), [1.0] * m
    for _ in range(rounds):
        prior = (sum(post) + 1) / (n + 2)
        log_p = []
        for side, right in ((0, 0), (1, 2)):
            p = [x if side else 1 - x for x in post]
            rows = []
            for v in range(m):
                c = [sum(w for w, r in zip(p, votes) if r[v] == vote) for vote in (-1, 0, 1)]
                if v == 0:
                    c[right] += n
                rows.append([math.log((x + 1) / (sum(c) + 3)) for x in c])
            log_p.append(rows)
        shared = [[0.0] * m for _ in range(m)]
        for side in (0, 1):
            p = [x if side else 1 - x for x in post]
            total = sum(p)
            if total < 2:
                continue
            mean = [sum(w * r[v] for w, r in zip(p, votes)) / total for v in range(m)]
            cov = [[sum(w * (r[a] - mean[a]) * (r[b] - mean[b]) for w, r in zip(p, votes)) / total for b in range(m)] for a in range(m)]
            sd = [math.sqrt(max(cov[a][a], 1e-12)) for a in range(m)]
            for a in range(m):
                for b in range(m):
                    shared[a][b] += (cov[a][b] / (sd[a] * sd[b])) ** 2 * total / n
        for a in range(m):
            shared[a][a] = 1.0
        weight = [1 / sum(row) for row in shared]
        weight[0] = 1.0
        new = []
        for r in votes:
            z = math.log(prior) - math.log(1 - prior) + sum((log_p[1][v][r[v] + 1] - log_p[0][v][r[v] + 1]) * weight[v] for v in range(m))
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        done = max(abs(x - y) for x, y in zip(new, post)) < 1e-4
        post = new
        if done:
            break
    return post


def plain_weights(rows, target, width):
    """The logistic regression, one row and feature at a time."""
    positive, n = sum(target), len(rows)
    cost = [t / max(2 * positive, 1e-9) + (1 - t) / max(2 * (n - positive), 1e-9) for t in target]
    w, m, s = ([0.0] * (width + 1) for _ in range(3))
    for t in range(1, 301):
        g = [1e-4 * x for x in w]
        g[width] = 0.0
        for features, y, c in zip(rows, target, cost):
            z = max(-30.0, min(30.0, sum(w[f] for f in features) + w[width]))
            err = c * (1 / (1 + math.exp(-z)) - y)
            for f in (*features, width):
                g[f] += err
        for i in range(width + 1):
            m[i] = 0.9 * m[i] + 0.1 * g[i]
            s[i] = 0.99 * s[i] + 0.01 * g[i] * g[i]
            w[i] -= 0.1 * (m[i] / (1 - 0.9**t)) / (math.sqrt(s[i] / (1 - 0.99**t)) + 1e-9)
    return w


def plain_toxicity(docs, labels):
    """{doc_id: score}: terms, voters, posteriors and classifier, without Spark and numpy."""
    train = sorted((i, y) for i, y in labels.items() if zlib.crc32(str(i).encode()) % 5)
    n_of = Counter(y for _, y in train)
    terms_of = {i: {t for w in docs[i].lower().split() for t in T.word_terms(w)} for i, _ in train}
    by = {y: Counter(t for i, z in train if z == y for t in terms_of[i]) for y in (0, 1)}
    strength = {}
    for t in by[0].keys() | by[1].keys():
        a, b = by[1][t], by[0][t]
        if a + b >= T.LEAST_DOCUMENTS:
            strength[t] = (math.log((a + 0.5) / (n_of[1] + 1)) - math.log((b + 0.5) / (n_of[0] + 1))) * math.sqrt(a + b)
    toxic = sorted((t for t in strength if strength[t] > 0), key=lambda t: (-strength[t], t))[: T.TERMS // 2]
    clean = sorted((t for t in strength if strength[t] < 0), key=lambda t: (strength[t], t))[: T.TERMS // 2]
    terms = toxic + clean

    def features(text):
        own = {t for w in text.lower().split() for t in T.word_terms(w)}
        return [i for i, t in enumerate(terms) if t in own] + [len(terms) + k for k, p in enumerate(T.PATTERNS) if p.search(text)]

    rows = [features(docs[i]) for i, _ in train]
    left, chosen = [{f for f in r if f < len(toxic)} for r, (_, y) in zip(rows, train) if y == 1], []
    while left and len(chosen) < T.TOXIC_VOTERS:
        n = Counter(f for r in left for f in r)
        if not n:
            break
        chosen.append(min(n, key=lambda f: (-n[f], f)))
        left = [r for r in left if chosen[-1] not in r]
    votes = []
    for r, (_, y) in zip(rows, train):
        hits = sum(f < len(toxic) for f in r)
        own = [2 * y - 1, *(int(f in r) for f in chosen)]
        own += [-int(len(toxic) + k in r) for k in range(min(T.CLEAN_VOTERS, len(clean)))]
        own += [int(len(terms) + k in r) for k in range(len(T.PATTERNS))]
        votes.append([*own, int(hits >= 2), 0 if hits else -1])
    post = plain_label_model(votes, [float(y) for _, y in train])
    w = plain_weights(rows, post, len(terms) + len(T.PATTERNS))
    out = {}
    for i, text in docs.items():
        z = max(-30.0, min(30.0, w[-1] + sum(w[f] for f in features(text))))
        out[i] = 1 / (1 + math.exp(-z))
    return out


def test_toxicity_equals_a_plain_rebuild(spark):
    r = np.random.default_rng(12)
    bad, good = ["idiots", "stupidly", "hateful", "you"], ["kindly", "garden", "music"]
    docs, labels = {}, {}
    for i in range(70):
        y = int(i % 3 == 0)
        own = [*r.choice(bad if y else good, 2), *r.choice(["the", "house", "river", "walks", "green"], 6), *(["!!!!"] if y and r.random() < 0.5 else [])]
        docs[i] = " ".join(own).capitalize() + ("" if r.random() < 0.8 else " STUPID" if y else " Music.")
        labels[i] = y if r.random() < 0.95 else 1 - y
    docs[70] = ""
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    known = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = {x.doc_id: x.score for x in T.toxicity(d, known).collect()}
    want = plain_toxicity(docs, labels)
    assert got.keys() == want.keys()
    for i in got:
        assert got[i] == pytest.approx(want[i], rel=1e-4, abs=1e-6), docs[i]
    assert sum((got[i] > 0.5) == bool(y) for i, y in labels.items()) > 60


def test_labels_outside_0_and_1_are_none(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet").selectExpr("doc_id", "cast(toxic as long) toxic")
    a = sorted((r.doc_id, r.score) for r in T.toxicity(docs, labels).collect())
    odd = labels.selectExpr("doc_id", "cast(-1 as bigint) toxic").union(docs.selectExpr("doc_id", "if(doc_id % 2 = 0, 2L, null)"))
    few = labels.selectExpr("doc_id", "5000000000 toxic")
    assert sorted((r.doc_id, r.score) for r in T.toxicity(docs, labels.union(odd).union(few)).collect()) == a
    assert {r.score for r in T.toxicity(docs, odd).collect()} == {0.5}


def test_a_document_repeated_many_times_is_learned_once(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet").select("doc_id", "toxic")
    i = next(r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5)
    many = docs.union(docs.where(f"doc_id = {i}").selectExpr("doc_id", "text", "explode(sequence(1, 100000)) n").select("doc_id", "text"))
    assert T._sample(many, labels.withColumnRenamed("toxic", "label"), 5, 0).count() <= labels.count()
    a = {r.doc_id: r.score for r in T.toxicity(docs, labels).collect()}
    assert {r.doc_id: r.score for r in T.toxicity(many, labels).distinct().collect()} == a


def test_terms_ignore_outer_punctuation():
    assert T.word_terms("(word).") == ("word",)
    assert T.word_terms("longword!") == ("longword", "long*", "longw*", "longwo*")
    assert T.word_terms("...") == ()
    assert list(itertools.chain(T.word_terms("ab"))) == ["ab"]
