"""Operators 11 to 13 against brute force: prefix trie, periodic runs, p-stable hashing."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from foldwise.llm import queries, runs, stable, trie
from tests.conftest import MEDIUM, SMALL

TURNS = "conv_id long, turn long, role string, text string, depth long, conv string"


@pytest.fixture(scope="module")
def llm(spark):
    return queries.on_workers(spark)


def brute_trie(rows):
    """{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, ends)} of (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + x[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            node = tuple(built[c][:d])
            members[node].append(c)
            if d:
                children[node[:-1]].add(node)
        ends[tuple(built[c])].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * len(node[-1][1] if node else "") + sum(saved[x] for x in children[node])
    return {
        (m[0], len(n)): (members[n[:-1]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    }


def tries(df):
    return {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in trie.trie(df).collect()}


def test_trie_equals_brute_force_with_a_long_conversation_and_nested_ways(llm):
    rng = random.Random(3)
    rows = [(c, i, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é€", ""])) for c in range(400) for i in range(rng.randint(1, 7))]
    rows += [(700, i, "user", f"turn {i % 3}") for i in range(3000)]  # spread over partitions
    rows += [(c, i, "user", f"turn {i % 3}") for c in range(701, 730) for i in range(20 * (c - 700))]  # each way hangs on the one before
    rows += [(950, None, None, None), (950, None, "user", "x"), (951, 2, "user", "x"), (951, 2, "user", "x"), (951, 2, "assistant", "x")]
    rows += [(None, 0, "user", "nobody's"), (10**15 + 3, 0, "user", "far off")]
    rng.shuffle(rows)
    df = llm.createDataFrame([(*r, 9, "clash") for r in rows], TURNS)
    assert tries(df) == brute_trie(rows)


def test_trie_of_turnless_conversations_and_of_nothing(llm):
    short = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 >= 2)  # its base is absent, its turn is replaced
    rows = [(short, 0, "user", "gone"), (310, 0, "user", "x")]
    got = tries(llm.createDataFrame([(*r, 0, "") for r in rows], TURNS))
    assert got == brute_trie(rows) and (short, 0) in got
    assert trie.trie(llm.createDataFrame([], TURNS)).count() == 0
    assert trie.trie(llm.createDataFrame([(None, 0, "user", "x", 0, "")], TURNS)).count() == 0


def test_fingerprints_join_as_a_monoid():
    values = np.random.default_rng(1).integers(0, 1 << 32, 50)
    r, prime = 123456789, trie.PRIMES[2]
    powers = np.array([pow(r, i, prime) for i in range(60)])
    whole = lambda v: sum(int(t) * pow(r, i, prime) for i, t in enumerate(v, 1)) % prime
    first = np.zeros(50, bool)
    first[[0, 20]] = True
    place = np.concatenate([np.arange(1, 21), np.arange(1, 31)])
    up, before = trie.sums(values, r, prime, powers, place, first, 0)
    assert [int(x) for x in up] == [whole(values[:i]) for i in range(1, 21)] + [whole(values[20:i]) for i in range(21, 51)]
    assert before[0] == 0 and before[20] == 0 and before[19] == up[18]
    more, _ = trie.sums(values[30:], r, prime, powers, place[30:], first[30:], int(up[29]))  # goes on in another batch
    assert (more == up[30:]).all()
    assert (int(up[19]) + pow(r, 20, prime) * int(up[49])) % prime == whole(values)


def test_a_fingerprint_collision_is_seen_and_hashed_anew(llm, monkeypatch):
    asked = []

    def weak(seed):
        asked.append(seed)
        return [1] * 4 if seed == 0 else real(seed)  # prefixes of the same turns in any order meet

    real = trie.factors
    monkeypatch.setattr(trie, "factors", weak)
    own = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 0][:4]
    rows = [(c, i, "user", "xyz"[(i * (1 + k % 2) + k) % 3]) for k, c in enumerate(own) for i in range(3)]
    df = llm.createDataFrame([(*r, 0, "") for r in rows], TURNS)
    assert tries(df) == brute_trie(rows) and 1 in asked


def brute_runs(w, least, times):
    """Every period is tried at every place."""
    known = {}
    x = np.array([known.setdefault(a, len(known)) for a in w], dtype=np.int64)
    out = []
    for q in range(1, len(x) // times + 1):
        same = np.concatenate([[0], (x[q:] == x[:-q]).astype(np.int8), [0]])
        turns = np.diff(same)
        for a, b in zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist(), strict=True):
            long = b - a + q
            if long >= max(least, times * q) and not any((x[a : a + long - p] == x[a + p : a + long]).all() for p in range(1, q)):
                out.append((a, long, q))
    return sorted(out, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 2), (9, 3)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(least)
    found = 0
    for _ in range(700):
        n = rng.randint(0, 120)
        w = [rng.randrange(rng.choice([1, 2, 3, 10])) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            a, p = rng.randrange(n + 1), rng.randint(1, 14)
            for i in range(a + p, min(n, a + p * rng.randint(2, 6))):
                w[i] = w[i - p]
        want = brute_runs(w, least, times)
        assert runs.find_runs(w, least, times) == want
        found += len(want)
    assert found > 100


def test_runs_inside_a_run_and_of_a_long_text():
    line = [f"w{i}" for i in range(40)] + ["ha"] * 30
    w = ["a"] * 5 + line * 4 + ["z"]
    assert runs.find_runs(w) == brute_runs(w, 24, 3)
    assert runs.find_runs(list(range(3)) * 20000) == [(0, 60000, 3)]
    assert runs.find_runs([f"w{i}" for i in range(5000)]) == [] and runs.find_runs([]) == []


def test_run_digests_equal_brute_force_on_whole_documents(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](llm, SMALL).collect()}
    assert set(got) == set(texts)
    seen = 0
    for doc_id, text in texts.items():
        words, h = text.encode().split(), zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want, row = brute_runs(words, 24, 3), got[doc_id]
        gone = {i for s, long, q in want for i in range(s + q, s + long)}
        left = b" ".join(x for i, x in enumerate(words) if i not in gone)
        assert row["n_runs"] == len(want)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{long},{q}\n" for s, long, q in want).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(left).hexdigest()
        if want:
            s, long, q = max(want, key=lambda run: (run[1] / run[2], -run[0], -run[2]))
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (s, long, q, 1000 * long // q)
            seen += 1
        else:
            assert row["start"] is row["length"] is row["period"] is row["exponent_milli"] is None
    assert seen > 5


def test_run_digests_of_odd_rows(llm):
    rows = [(None, None, 1), (None, "a " * 30, 1), (7, "", 1), (7, "x y \t\r\n z", 1), (8, "b c " * 40_000, 1)]
    df = llm.createDataFrame(rows, "doc_id long, text string, start int")
    keep = lambda doc_id, words: words
    got = [tuple(r)[:6] for r in runs.digests(df, rewrite=keep).collect()]
    none = (0, None, None, None, None)
    key = lambda t: tuple((x is not None, x or 0) for x in t)
    assert sorted(got, key=key) == sorted([(None, *none), (None, 1, 0, 30, 1, 30000), (7, *none), (7, *none), (8, 1, 0, 80000, 2, 40_000_000)], key=key)
    assert runs.digests(df.limit(0)).count() == 0


def brute_vectors(rows, cosine=0.98):
    sound = {i: np.array(v, float) for i, v, label in rows if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    labels = {i: label for i, _, label in rows}
    links = defaultdict(set)
    for i, a in sound.items():
        for j, b in sound.items():
            if i < j and labels[i] == labels[j] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i, _, _ in rows:
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        out[i] = (len(links[i]), min(reach), min(reach) == i)
    return out


def vectors(llm, rows):
    return llm.createDataFrame([(i, v, label, 0, 0.5) for i, v, label in rows], "vec_id long, embedding array<float>, label int, id int, n double")


def got_vectors(df, **more):
    return {r["id"]: (r["n_links"], r["root"], r["kept"]) for r in stable.near_duplicates(df, **more).collect()}


def test_links_equal_brute_force_around_the_threshold(llm):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for centre in rng.standard_normal((40, 32)):
        for spread in (0.0, 0.05, 0.1, 0.13, 0.14, 0.15, 0.2):
            for _ in range(3):
                rows.append((i * 7 % 9973, (centre * 10 ** rng.uniform(-3, 3) + spread * np.linalg.norm(centre) / 6 * rng.standard_normal(32)).astype("f4").tolist(), int(i % 3)))
                i += 1
    assert got_vectors(vectors(llm, rows)) == brute_vectors(rows)


def test_a_bucket_of_many_blocks_and_of_copies(llm):
    rng = np.random.default_rng(5)
    near = rng.standard_normal(16) + 0.02 * rng.standard_normal((2600, 16))
    rows = [(5 + i, v.astype("f4").tolist(), 1) for i, v in enumerate(near)] + [(5000 + i, [1.0] * 16, 1) for i in range(300)]
    got = got_vectors(vectors(llm, rows))
    assert all(got[5 + i] == (2599, 5, i == 0) for i in range(2600))
    assert all(got[5000 + i] == (299, 5000, i == 0) for i in range(300))


def test_vectors_that_link_with_nothing(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [2.0, 4.0], 1), (2, [1.0, 2.0], None), (3, None, 1), (4, [], 1), (5, [0.0, -0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1)]
    rows += [(8, [None, 1.0], 1), (9, [1.0, 2.0, 0.0], 1), (10, [1.0, 2.0], 2), (11, [1e-30, 2e-30], 1), (12, [1e30, 2e30], 1)]
    df = vectors(llm, rows)
    assert got_vectors(df) == brute_vectors([(i, v, label) if i != 11 else (i, [1.0, 2.0], 1) for i, v, label in rows])
    assert got_vectors(df.unionByName(df)) == got_vectors(df)  # repeated rows
    lone = stable.near_duplicates(vectors(llm, [(None, [1.0, 2.0], 1), (0, [1.0, 2.0], 1)])).collect()
    assert sorted((r["id"] or -1, r["n_links"], r["kept"]) for r in lone) == [(-1, 0, True), (-1, 0, True)]
    assert stable.near_duplicates(df.limit(0)).count() == 0


def test_tables_follow_from_the_miss_rate():
    for rows in (100, 10_000, 1_000_000_000):
        width, hashes, tables = stable.plan(0.98, rows, 1e-4)
        assert width == pytest.approx(2.0)
        assert (1 - stable.meeting(10) ** hashes) ** tables <= 1e-4
    assert stable.plan(0.98, 0, 1e-4)[1] == 1


def test_medium_vectors_match_a_scan(llm):
    out = queries.QUERIES["op13_stable_hashing"](llm, MEDIUM).collect()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in llm.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out} == brute_vectors(rows)
