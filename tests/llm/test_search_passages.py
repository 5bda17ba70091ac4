"""Nearest neighbours and shared passages against brute force."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.llm import ann, passages
from sheaf.llm.ann import nearest
from sheaf.llm.passages import GAP_COST, LEAST_SEEDS, chains, columns, longest, seeds_of, shared_passages, stretches, word_hashes

VECTORS = "vec_id long, embedding array<float>"


def exact(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = x @ x[i] / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[i]))
        order = [j for j in np.lexsort((ids, -np.round(score, 14))) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = nearest(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), F.col("vec_id") % 50 == 0).toPandas()
    want = exact(rows, 5)
    hit = 0
    for q, f in got.groupby("query_id"):
        assert f.sort_values("rank").score.is_monotonic_decreasing and f["rank"].tolist().sort() is None and len(f) == 5
        hit += len({*f.vec_id} & {v for v, _ in want[q]})
    assert hit / (5 * len(want)) >= 0.9 and got.query_id.nunique() == len(want)


def test_a_vector_on_a_third_of_the_rows_and_ties(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8).tolist()
    rows = [(k, hot if k % 3 == 0 else rng.normal(size=8).tolist()) for k in range(300)]
    got = nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0).toPandas()
    for q, f in got.groupby("query_id"):
        if q % 3 == 0:
            assert f.sort_values("rank").vec_id.tolist() == [v for v in range(0, 21, 3) if v != q][:5]


def test_search_nulls_lengths_repeats_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (50, [0.0, 1.0, 0.0]), (100, [1.0]), (150, None)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"dim": F.lit(1), "shard": F.lit(2), "score": F.lit("s")})
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(df, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 2), (50, 1, 9)]
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=25, unique=True))
def test_chain_scores_equal_the_quadratic_recurrence(points):
    x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    score = {}
    for a, b in sorted(points):
        before = [score[c, d] - GAP_COST * (a - c + b - d) for c, d in points if c < a and d < b]
        score[a, b] = 1 + max([0.0, *before])
    found = chains(x, y)
    best = max(score.values())
    for c in found:
        assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all() and len(c) >= LEAST_SEEDS
    if found:
        c = found[0]
        assert len(c) - GAP_COST * (x[c[-1]] - x[c[0]] + y[c[-1]] - y[c[0]]) >= best - 1e-9 or len(c) < len(points)


def test_seeds_meet_in_equal_runs():
    rng = random.Random(4)
    run = [b"w%d" % k for k in range(8)]
    for _ in range(50):
        a, b = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(20)] for _ in range(2))
        texts = [a[:7] + run + a[7:], b[:3] + run + b[3:]]
        owner, _, seed = seeds_of(np.concatenate([word_hashes(t, {}) for t in texts]), np.array([28, 28]))
        assert {*seed[owner == 0]} & {*seed[owner == 1]}


def test_alignment_over_an_insertion():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1000, 120)
    b = np.r_[a[:50], [5001, 5002], a[50:70], a[71:]]
    px, py, eq = columns(a, b, [10, 80], [10, 81], [30, 20])
    (x0, x1, y0, y1, part), = stretches(px, py, eq)
    assert (x0, x1, y0, y1) == (0, 120, 0, 121) and part > 0.95


def test_planted_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(4000)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [prose(70) for _ in range(5)]
    line, texts, holds = prose(14), [], {}
    for k in range(300):
        t = prose(rng.randint(30, 300)) + (line if k % 3 == 0 else [])
        if k % 10 == 0:
            p = k // 10 % 5
            holds.setdefault(p, set()).add(k)
            own = [w if rng.random() > 0.04 else rng.choice(words) for w in passages[p]]
            at = rng.randrange(len(t))
            t = t[:at] + own + t[at:]
        texts.append((k, rng.choice([" ", "\n"]).join(t)))
    long = " ".join(prose(30_000))
    texts += [(400, long), (401, long), (402, "w1 " * 200), (None, "short"), (403, None), (404, ""), (405, " ".join(passages[0]).upper())]
    holds[0].add(405)
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"row": F.lit("r"), "start": F.lit(1), "seed": F.lit(2)})
    got = shared_passages(docs).collect()
    linked = {}
    for r in got:
        assert min(r["end"] - r["start"], r["other_end"] - r["other_start"]) >= 50 and r["similarity"] >= 0.8
        linked.setdefault(r["doc_id"], set()).add(r["other_id"])
        linked.setdefault(r["other_id"], set()).add(r["doc_id"])
    assert set(linked) == {k for h in holds.values() for k in h} | {400, 401}
    for p, h in holds.items():
        group, todo = set(), [min(h)]
        while todo:
            k = todo.pop()
            if k not in group:
                group.add(k)
                todo += linked[k]
        assert group == h, p
    assert shared_passages(docs.limit(0)).count() == 0


def test_every_copy_of_a_passage_in_a_text_is_found(spark):
    rng = random.Random(7)
    prose = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    p, q = prose(70), prose(54)
    once, twice = prose(30) + p + prose(40), prose(20) + p + prose(90) + p + prose(30) + p
    teaser = prose(40) + q[:45] + prose(60) + q + prose(30)        # the opening of q, then q
    plain = prose(25) + q + prose(20)
    periodic = prose(8) * 3000
    texts = [once, twice, teaser, plain, prose(9) + periodic, periodic[:20000] + prose(5)]
    for order in (1, -1):
        rows = [(k, " ".join(t)) for k, t in list(enumerate(texts))[::order]]
        spans = {}
        for r in shared_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect():
            spans.setdefault(r["doc_id"], set()).add((r["start"], r["end"], r["other_id"]))
            spans.setdefault(r["other_id"], set()).add((r["other_start"], r["other_end"], r["doc_id"]))
        assert {(a, b) for a, b, o in spans[1] if o == 0} == {(20, 90), (180, 250), (280, 350)}
        assert (145, 199, 3) in spans[2] and (25, 79, 2) in spans[3]
        assert any(b - a >= 19990 for a, b, _ in spans[4]) and {o for _, _, o in spans[5]} == {4}


def test_fuzzy_passages_at_the_limit_are_found(spark):
    rng = random.Random(8)
    prose = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    rows, want = [], {}
    for k in range(600):
        n = (50, 55, 60)[k % 3]
        p = prose(n)
        changed = {*rng.sample(range(n), round(n * (0.2, 0.16, 0.1)[k // 3 % 3]) - n % 2)}
        rows += [(2 * k, " ".join(prose(70) + p + prose(70))),
                 (2 * k + 1, " ".join(prose(90) + [f"x{k}y{i}" if i in changed else w for i, w in enumerate(p)] + prose(70)))]
        # only passages whose changed words are not the ends are passages of n words
        equal = np.array([i not in changed for i in range(n)])
        if equal[0] and equal[-1] and stretches(70 + np.arange(n), 90 + np.arange(n), equal):
            want[2 * k] = max(len(w) for w in "".join("e" if e else " " for e in equal).split())
    got = {min(r["doc_id"], r["other_id"]) for r in shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [k in got for k, run in want.items() if run >= 5]
    print(len(want), sum(found), len(found))
    assert len(found) > 250 and all(found) and len(found) >= 0.95 * len(want)


@given(st.lists(st.booleans(), min_size=1, max_size=40))
def test_the_longest_stretch_is_that_of_all_stretches(flags):
    eq = np.array(flags)
    sizes = [b - a for a in range(len(eq)) for b in range(a + 1, len(eq) + 1) if eq[a] and eq[b - 1] and eq[a:b].mean() >= 0.8 - 1e-9]
    found = longest(eq, 0.8) if eq.any() else None
    assert (found[1] - found[0] if found else 0) == max(sizes, default=0)


def test_every_fuzzy_copy_with_a_partner_is_linked(spark):
    rng = random.Random(10)
    prose = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    rows, groups = [], []
    for rate in (0.1, 0.12):
        p = prose(60)
        copies = [[w if rng.random() >= rate else f"x{rng.randrange(10**9)}" for w in p] for _ in range(500)]
        groups.append((len(rows), np.array([[w == q for w, q in zip(c, p, strict=True)] for c in copies], int)))
        rows += [(len(rows) + k, " ".join(prose(rng.randint(20, 90)) + c + prose(40))) for k, c in enumerate(copies)]
    found = shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "other_id").toPandas()
    linked = np.zeros((len(rows), len(rows)), bool)
    linked[found.doc_id, found.other_id] = linked[found.other_id, found.doc_id] = True

    def reach(adjacent):
        label = np.arange(len(adjacent))
        while True:
            least = np.where(adjacent, label[None, :], len(label)).min(axis=1)
            new = np.minimum(label, least)
            if (new == label).all():
                return label
            label = new
    for base, kept in groups:
        # equal words of two copies, brute force over all pairs; a copy's changed words are its own
        like = (kept @ kept.T) >= 48
        np.fill_diagonal(like, False)
        mine = linked[base:base + 500, base:base + 500]
        want, got = like.any(axis=1), mine.any(axis=1)
        a, b = reach(like), reach(mine)
        print(want.sum(), (want & got).sum(), len(np.unique(a)), len(np.unique(b)))
        assert got[want].all() and all((b[like[k]] == b[k]).all() for k in range(500))


def test_alignment_of_a_long_gap_without_seeds():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 10**6, 700)
    b = np.r_[a[:300], [-1], a[300:]]
    b[100:600:20] = -2                                             # and changed words inside
    (x0, x1, y0, y1, part), = stretches(*columns(a, b, [0, 650], [0, 651], [60, 50]))
    assert (x0, x1, y0, y1) == (0, 700, 0, 701) and part > 0.95


def test_very_large_and_small_components_take_part(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 6))
    scale = np.array([1e-200, 1.0, 1e200, 1e-300])[np.arange(120) % 4]
    rows = [(k, (v * s).tolist()) for k, (v, s) in enumerate(zip(x, scale, strict=True))]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 3).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert len(got) == 18
    assert all(abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-9 for r in got.itertuples())


def test_query_blocks_meet_shards_without_a_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(13)
    rows = [(k, rng.normal(size=(6, 3)[k % 7 == 0]).tolist()) for k in range(400)]
    rows += [(400 + k, (2.0 * np.array(rows[k][1])).tolist()) for k in range(40)]
    plans, settle = {}, ann.settle
    monkeypatch.setattr(ann, "settle", lambda df, name: plans.update({name: df._jdf.queryExecution().toString()}) or settle(df, name))
    for name, few in (("SHARD_CELLS", 240), ("SEARCH_TASKS", 3), ("TASK_BYTES", 30_000), ("BLOCK_QUERIES", 10)):
        monkeypatch.setattr(ann, name, few, raising=False)      # many shards in some groups, many blocks
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 5 == 0, 4)
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got.collect()}
    assert "Broadcast" not in plans["found"]
    for q, v in rows[::5]:
        like = sorted((-np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)), k) for k, w in rows if k != q and len(w) == len(v))
        best = [found.get((q, n + 1), (None, 0.0)) for n in range(4)]
        # by shards of so few entries, a query mostly scans them whole
        assert np.allclose([s for _, s in best], [-s for s, _ in like[:4]], atol=0.02) and len({k for k, _ in best}) == 4


def test_a_passage_is_found_where_others_hold_its_seeds_only(spark):
    rng = random.Random(11)
    prose = lambda n: [f"t{rng.randrange(10**6)}" for _ in range(n)]
    p, line = prose(60), prose(14)

    def pieces():                                                 # every 5 words of p, never more than 12
        return [w for k in range(0, 56, 8) for w in p[k:k + 12] + prose(40)]

    changed = [w if k % 9 else f"z{k}" for k, w in enumerate(p[1:], 1)]
    texts = [pieces(), prose(30) + p + prose(40), pieces(), pieces(), prose(80) + p[:1] + changed + prose(20), pieces(), pieces(),
             prose(10) + p[:30] + prose(2) + p[30:] + prose(9), pieces()]
    texts += [prose(40) + line + prose(40) for _ in range(200)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    found = {(r["doc_id"], r["other_id"]) for r in shared_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    linked = {k for pair in found for k in pair}
    assert linked == {1, 4, 7} and len({frozenset(pair) for pair in found}) >= 2


def test_occurrences_that_share_another_run_are_those_that_share_a_passage(monkeypatch):
    rng = np.random.default_rng(12)
    n = 60
    flank = rng.integers(1, 60_000, (n, 2 * passages.REACH)).astype(np.uint16)
    flank[:, passages.REACH:passages.REACH + 9] = flank[0, passages.REACH:passages.REACH + 9]     # a line of 14 words
    for k in range(30, 60, 2):
        near = np.r_[0:35, passages.REACH:passages.REACH + 35]
        flank[k, near] = np.where(rng.random(70) < 0.9, flank[k + 1, near], 60_001)
    row, no, none = np.arange(n), np.zeros(n, bool), np.zeros(n, np.int64)
    found = {}
    for few in (0, n):
        monkeypatch.setattr(passages, "FEW", few)
        found[few] = passages.cell_pairs(row, none, none - 1, no, no, no, None, flank)
    assert found[0] == found[n] and {(k + 1, k) for k in range(30, 60, 2)} >= {*found[n]} and len(found[n]) > 10


def test_a_common_line_is_no_reason_to_compare_texts():
    rng = np.random.default_rng(3)
    n, reach = 2000, passages.REACH
    often = rng.integers(1, 20, (n, 2 * reach))                   # every third word is one of a few
    flank = np.where(rng.random((n, 2 * reach)) < 0.3, often, rng.integers(100, 65_000, (n, 2 * reach))).astype(np.uint16)
    flank[:, reach:reach + 8] = flank[0, reach:reach + 8]         # a line of 13 words, followed by a frequent one
    flank[:, reach + 8] = 7
    near = np.r_[0:40, reach:reach + 40]
    for k in range(0, 40, 2):
        flank[k, near] = np.where(rng.random(80) < 0.93, flank[k + 1, near], 65_001)
    kind = np.arange(n)
    met = {(i, j) for some in passages.sharing(flank, kind) for i, j in zip(*(c.tolist() for c in some), strict=True)}
    assert {(k, k + 1) for k in range(0, 40, 2)} <= met and len(met) < n * n / 20
    row, no, none = np.arange(n), np.zeros(n, bool), np.zeros(n, np.int64)
    found = passages.cell_pairs(row, none, none - 1, no, no, no, None, flank)
    assert {*found} <= {(k + 1, k) for k in range(0, 40, 2)} and len(found) > 10


def test_texts_of_one_word_that_are_too_short_to_link_are_not_aligned(monkeypatch):
    reach, n = passages.REACH, 60
    flank = np.zeros((n, 2 * reach), np.uint16)
    for k in range(n):                                            # 5 words and 35 to 44 more of them, then others
        flank[k, reach:] = 1000 + k
        flank[k, reach:reach + 35 + k % 10] = 7
    flank[-2:, reach:] = 7                                        # two that are long enough
    aligned = []
    linked_at = passages.linked_at
    monkeypatch.setattr(passages, "linked_at", lambda a, b: aligned.append(1) or linked_at(a, b))
    row, no, none = np.arange(n), np.zeros(n, bool), np.zeros(n, np.int64)
    assert passages.cell_pairs(row, none, none - 1, no, no, ~no, None, flank) == [(n - 1, n - 2)]
    assert len(aligned) == 1


def test_occurrences_left_out_know_their_neighbours():
    rng = random.Random(14)
    for size in (0, 1, 2, 3, 60):
        at = sorted({(rng.randrange(3), rng.choice([k * 7, rng.randrange(90)])) for k in range(size)})
        seed = {a: rng.randrange(3) for a in at}
        mixed = rng.sample(at, len(at))
        got = passages.neighbours(np.array([r for r, _ in mixed], int), np.array([seed[a] for a in mixed], int), np.array([p for _, p in mixed], int))
        assert [(r, p) for r, _, p, *_ in zip(*got, strict=True)] == at
        inside = {}
        for r, p in at:
            own = [q for o, q in at if o == r and seed[o, q] == seed[r, p]]
            k = own.index(p)
            inside[r, p] = 0 < k < len(own) - 1 and own[k + 1] - p == p - own[k - 1] < passages.LEAST_WORDS
        for r, s, p, before, is_inside, ends in zip(*(c.tolist() for c in got), strict=True):
            own = [q for o, q in at if o == r and seed[o, q] == s]
            k = own.index(p)
            near = [own[j] for j in (k - 1, k + 1) if 0 <= j < len(own)]
            assert s == seed[r, p] and before == seed.get((r, p - 1), -1)
            assert is_inside == inside[r, p] and ends == any(inside[r, q] for q in near)


def test_seed_occurrences_are_sorted_whatever_their_order():
    rng = np.random.default_rng(15)
    for low, high in ((0, 50), (0, 1 << 40), (-(1 << 62), 1 << 62)):
        row, pos = np.divmod(np.sort(rng.choice(4000, 900, replace=False)), 40)
        seed = rng.choice(rng.integers(low, high, 60), 900)
        for order in (np.arange(900), rng.permutation(900)):
            got = passages.by_seed(seed[order], row[order], pos[order])
            assert [*zip(*got, strict=True)] == sorted(zip(seed, row, pos, strict=True))
