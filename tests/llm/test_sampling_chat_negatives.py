"""Importance resampling, chat windows and hard negatives against brute force and on odd rows."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import duckdb  # noqa: E402

from mixcast.llm import chat, hard_negatives, queries, resampling  # noqa: E402
from mixcast.llm.common import ready  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ready(spark)


def sql_rows(name, **tables):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables.get(t, f'{SF}/{t}.parquet')}'")
    return sorted(con.execute(queries.ORACLE_SQL[name]).fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_chat_windows", "op13_hard_negatives"])
def test_query_equals_sql(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert sorted(map(tuple, out.collect()), key=repr) == sql_rows(name)


# --- importance resampling

def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected_ranks(docs, target, longest, buckets, percent, least, seed):
    def feats(t):
        w = words(t)
        return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    code = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(code, feats(x)))
    for x in target:
        t.update(map(code, feats(x)))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        w = sum(math.floor(1000 * math.log((t[k] + 1.0) * (big_s + buckets) / ((s[k] + 1.0) * (big_t + buckets))))
                for k in map(code, feats(x)))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(feats(x)), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x))])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): n + 1 for n, r in enumerate(fit[:percent * len(fit) // 100])}
    return sorted([(*r[:4], drawn.get(id(r))) for r in out], key=repr)


def test_resampling_matches_brute_force_on_odd_rows(spark):
    rng = random.Random(3)
    vocab = ["Alpha", "beta", "Ünï", "漢字", "x9", "ＡＢ", "delta", "it's", "\x1c", "o\x00p"]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(0, 40)))) for i in range(300)]
    docs += [(None, "alpha beta " * 15), (400, None), (401, ""), (402, "beta " * 30000), (-7, "alpha " * 25), (1 << 62, "beta " * 25)]
    target = ["alpha alpha beta", None, "", "漢字 x9 " * 9]
    df = spark.createDataFrame([(i, x, 1, "a", 2.0) for i, x in docs], "doc_id long, text string, words int, score string, rank double")
    aim = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id int")
    for longest, buckets, percent in ((1, 10000, 10), (3, 97, 100), (2, 70000, 35)):
        got = resampling.resample(df, aim, "doc_id", longest=longest, buckets=buckets, percent=percent)
        assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
        assert sorted(map(tuple, got.collect()), key=repr) == expected_ranks(docs, target, longest, buckets, percent, 20, 2024)


def test_resampling_of_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(df, df, "doc_id").count() == 0
    one = spark.createDataFrame([(1, "a " * 20)], "doc_id long, text string")
    assert resampling.resample(one, df, "doc_id", percent=100).first()["rank"] == 1


def test_radix_rank_orders_repeated_and_wide_keys(spark):
    rng = random.Random(5)
    keys = [(rng.choice([0, 1, 7, 1 << 40, -1, -(1 << 63)]), rng.randrange(-50, 50), n) for n in range(6000)]
    keys += [(7, 7, 9)] * 3000  # a third of all rows under one key
    rows = resampling.radix_rank(spark.createDataFrame(keys, "a long, b long, n long").repartition(5), ["a", "b"]).collect()
    assert sorted(r.position for r in rows) == list(range(len(keys)))
    unsigned = lambda x: x & ((1 << 64) - 1)
    got = [(unsigned(r.a), unsigned(r.b)) for r in sorted(rows, key=lambda r: r.position)]
    assert got == sorted((unsigned(a), unsigned(b)) for a, b, _ in keys)


# --- chat windows

CHAT = "conv_id long, turn long, role string, text string, window string, at int"
MARKS = ["<|im_end|>", "<|im_start|>", "<|", "<\\|", "<\\\\|x", "<", "|", "\n", "<|im_end|>\n", "\\n", "é漢😀"]


def talk(rows):
    """role, text of each conversation's turns, in order."""
    convs = defaultdict(list)
    for c, t, role, text, *_ in rows:
        convs[c].append(((t is not None, t or 0, role or ""), role or "", text or ""))
    return {c: [(r, x) for _, r, x in sorted(v, key=lambda e: e[0])] for c, v in convs.items()}


def odd_talks():
    rng = random.Random(8)
    rows = []
    for c in range(60):
        n = rng.randrange(1, 30)
        for t in range(n):
            role = "system" if t == 0 and c % 3 else rng.choice(["user", "assistant", "tool\nx", "a\\nb", "<|im_end|>"])
            text = " ".join(rng.choices(MARKS + ["word"], k=rng.choice([0, 1, 5, 40, 200])))
            rows.append((c, t, role, text, "w", t))
    rows += [(None, 0, None, None, None, None), (None, 1, "assistant", "ok", None, None), (100, None, "user", "first", None, None),
             (100, 0, "assistant", "second", None, None), (101, 0, "system", "alone", None, None),
             (102, 0, "assistant", "long " * 9000, None, None), (103, 0, "user", "", None, None)]
    rows += [(104, 1, "user", "again and again", None, None)] * 400  # repeated rows: turns like any other
    rows += [(105, t, "assistant" if t % 2 else "user", f"turn {t} of a long talk " * 4, None, None) for t in range(900)]
    return rows


def test_chat_reads_back(spark):
    rows = odd_talks()
    back = chat.read_back(chat.windows(spark.createDataFrame(rows, CHAT).repartition(4), "conv_id")).collect()
    want = talk(rows)
    assert {r.conv for r in back} == set(want)
    for r in back:
        assert r.turns == "".join(f"{a}\n{b}\n" for a, b in want[r.conv]) and r.n_turns == len(want[r.conv])
        assert r.loss == "".join(b for a, b in want[r.conv] if a == "assistant")


def test_chat_windows_keep_budget_system_and_history(spark):
    rows = odd_talks()
    df = spark.createDataFrame(rows, CHAT)
    wins = chat.windows(df, "conv_id", budget=400).collect()
    talks, convs = talk(rows), defaultdict(list)
    for w in sorted(wins, key=lambda w: (w.conv is None, w.conv or 0, w.window)):
        convs[w.conv].append(w)
    assert len(convs[105]) > 20
    for c, ws in convs.items():
        turns, nxt = talks[c], 0
        for n, w in enumerate(ws):
            parts = w.text.split("<|im_end|>\n")[:-1]
            assert all(p.startswith("<|im_start|>") and "<|" not in p[2:] for p in parts)
            lead = turns[0][0] == "system"
            if n and lead:
                assert parts[0] == ws[0].text.split("<|im_end|>\n")[0]  # the system turn stays
            held = w.repeated - (1 if n and lead else 0)
            fresh = len(parts) - w.repeated
            assert (w.repeated == 0) if n == 0 else (0 <= held <= nxt)
            alone = fresh - (lead and not n) <= 1  # one turn beside the system turn
            assert w.tokens <= 400 or alone or len(turns[0][1]) > 100  # only it or a large system turn passes the budget
            # history ends where the new turns begin
            tails = [p.split("\n", 1)[1] for p in parts[w.repeated - held:]]
            assert [len(x) for x in tails] == [len(re.sub(r"<(\\*)\|", r"<\\\1|", x)) for _, x in turns[nxt - held:nxt + fresh]]
            learnt = sum(a == "assistant" for a, _ in turns[nxt:nxt + fresh])
            assert len(w.loss) == learnt
            nxt += fresh
        assert nxt == len(turns)


def test_chat_of_an_empty_table(spark):
    none = spark.createDataFrame([], CHAT)
    assert chat.windows(none, "conv_id").count() == 0 and chat.read_back(chat.windows(none, "conv_id")).count() == 0


# --- hard negatives

VEC = "vec_id long, embedding array<double>, label int, rank string, u string, score int"


def expected_negatives(rows, positives, negatives, share, scale):
    fit = [(i, k, [math.floor(scale * x) for x in v]) for i, v, k in rows
           if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, k, q) in enumerate(fit):
        if i % 10:
            continue
        near = sorted((-sum(a * b for a, b in zip(q, v)), j, c) for m, (j, c, v) in enumerate(fit) if m != n and len(v) == len(q))
        for s, j, _ in [x for x in near if x[2] == k][:positives]:
            hard = [x for x in near if x[2] != k and share[0] * -s <= 100 * -x[0] <= share[1] * -s][:negatives]
            out += [(i, j, r + 1, y, -s, -t) for r, (t, y, _) in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("dim,scale", [(5, 256.0), (64, 256.0), (100, 1e3), (9, 2e8)])
def test_hard_negatives_match_brute_force(spark, monkeypatch, dim, scale):
    monkeypatch.setattr(hard_negatives, "PAGE", 64 * dim)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 16)
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(6, dim))
    rows = [(i, (centres[i % 6] + rng.normal(size=dim) * rng.choice([0.0, 0.3, 1.0])).tolist(), int(rng.integers(4))) for i in range(400)]
    rows += [(400, rows[0][1], 1), (400, rows[0][1], 1), (410, [0.0] * dim, 0), (None, rows[1][1], 1), (411, None, 1), (412, rows[3][1], None),
             (413, [None] + rows[4][1][1:], 1), (414, [float("nan")] * dim, 1), (415, [float("inf")] * dim, 1), (420, [1.0, 2.0], 0),
             (421, [1.0, 1.0], 0), (422, [0.5, 1.0], 1), (430, [], 0), (431, [], 0), (432, [], 1)]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], VEC)
    got = hard_negatives.mine(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0, 5, 10, (30, 90), scale)
    assert sorted(map(tuple, got.collect())) == expected_negatives(rows, 5, 10, (30, 90), scale)


def test_intervals_hold_every_score_and_rule_rows_out():
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.normal(size=(3000, 64)) / 8)
    x[:40] = x[0] + np.floor(rng.normal(size=(40, 64)))
    codes, ones, along, rest = hard_negatives.encode(x)
    longs = np.arange(3000).tobytes()
    page = hard_negatives._Page(type("R", (), dict(
        n=3000, dim=64, u=longs, ids=longs, labels=longs, vecs=x.astype(np.int64).tobytes(), codes=codes.tobytes(), ones=ones.tobytes(),
        along=along.tobytes(), rest=rest.tobytes())))
    turned = hard_negatives._turned(x[:50])
    left = []
    for i in range(50):
        true = x @ x[i]
        at = page.survivors(np.arange(3000), hard_negatives._Anchor(turned[:, i]), np.array([-np.inf]), np.array([np.inf]), 10)
        assert set(np.argsort(-true, kind="stable")[:10]) <= set(at) or true[at].min() <= np.sort(true)[-10]
        assert set(np.flatnonzero(true > np.sort(true)[-10])) <= set(at)
        left.append(len(at))
    assert np.mean(left) < 600  # a fifth of the rows


def test_hard_negatives_of_an_empty_table(spark):
    none = spark.createDataFrame([], VEC)
    assert hard_negatives.mine(none, "vec_id", "embedding", F.col("label"), F.lit(True), 5, 10, (30, 90), 256.0).count() == 0
