"""Each operator against brute force, libraries or held-out labels; nulls, ties, repeats, empty tables, clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foldwise.llm import chat, components, langid, lm, neardup, packing, pages, pieces, quality, queries, topk, vptree, words
from foldwise.llm.bpe import NONE, Pairs, merge, merged_words
from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string"
LONG = "word " * 30_000


def frame(spark, rows, schema=DOCS):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


@pytest.fixture(scope="module")
def llm(spark):
    return queries.on_workers(spark)


def odd_docs(spark):
    texts = [None, "", "  \n\t ", "one", "two words", "Der Hund & die Katze", "日本語 テキスト", LONG, "a\x00b \x1c c", "</s> <|endoftext|> ▁x  y "]
    return frame(spark, [{"doc_id": i, "text": t, "lang": "en" if i % 2 else None, "score": 0.5, "ids": "x"} for i, t in enumerate(texts)])


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_classes(docs, n, percent):
    """doc -> (set size, smallest id reachable), all pairs compared."""
    sets = {i: shingles(t, n) for i, t in docs.items()}
    root = {i: i for i in docs}
    ids = sorted(docs)
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed = changed or root[a] != root[b]
            root[a] = root[b] = low
    return {i: (len(sets[i]), root[i]) for i in docs}


def near_copies():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    docs, at = {}, 0
    for length in (1, 2, 3, 12, 40, 90, 230, 420):
        base = rng.choice(vocabulary, length).tolist()
        for edits in (0, 0, 1, 2, 4, 8, 16):
            own = list(base)
            for p in rng.integers(0, length, min(edits, length)):
                own[p] = str(rng.choice(vocabulary))
            docs[at] = " ".join(own)
            at += 1
    shared = " ".join(rng.choice(vocabulary, 60))
    for _ in range(30):  # a passage that many share makes no copies
        docs[at] = f"{shared} {' '.join(rng.choice(vocabulary, 60))}"
        at += 1
    return docs


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_all_pairs(llm, n, percent):
    docs = near_copies()
    df = frame(llm, [{"doc_id": i, "text": t} for i, t in docs.items()])
    got = {r["id"]: (r["n"], r["root"]) for r in neardup.near_duplicates(df, n, percent).collect()}
    assert got == brute_classes(docs, n, percent)


def test_short_sets_are_compared_whatever_their_sketches(llm):
    vocabulary = [f"w{i}" for i in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(vocabulary)], names=["text"])
    by_hash = [w for _, w in sorted((int(own[0]), w) for own, w in zip(neardup.shingle_sets(batch, "text", 1), vocabulary, strict=True))]
    low, common = by_hash[:42], by_hash[-171:]  # 171 of 213 shared, but 54 of the 96 smallest
    df = frame(llm, [{"doc_id": 0, "text": " ".join(low[::2] + common)}, {"doc_id": 1, "text": " ".join(low[1::2] + common)}])
    assert sorted((r["id"], r["n"], r["root"]) for r in neardup.near_duplicates(df, 1, 80).collect()) == [(0, 192, 0), (1, 192, 0)]


def test_near_duplicates_odd_rows(llm):
    df = odd_docs(llm).unionByName(frame(llm, [{"doc_id": 3, "text": "one"}, {"doc_id": 20, "text": "ONE\n"}, {"text": "one"}]))
    got = {r["id"]: (r["n"], r["root"]) for r in neardup.near_duplicates(df, 3, 85).collect()}
    assert got[0] == (0, 0) and got[1] == (0, 1) and got[2] == (0, 2) and got[20] == (1, 3) and got[7][0] == 1
    kept = neardup.one_of_each(df).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == list(range(10))
    assert neardup.near_duplicates(df.limit(0), 3, 85).count() == 0


def test_components_follow_chains_and_stars(llm):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)] + [(7, 3), (3, 7), (9, 9)]
    got = {r["id"]: r["root"] for r in components.contract(llm.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 560)} | {3: 3, 7: 3}


def test_word_hashes_are_those_of_words():
    texts = ["The the THE", None, "", " a\tb\r\n a", "é É", "x" * 5000, "b a"]
    hashes, offsets = words.word_hashes(pa.array(texts).slice(1))
    flat = [w for t in texts[1:] for w in (t or "").encode().lower().split()]
    assert np.diff(offsets).tolist() == [len((t or "").encode().lower().split()) for t in texts[1:]]
    by = {}
    for w, h in zip(flat, hashes.tolist(), strict=True):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


def test_sentencepiece_matches_library(llm):
    import sentencepiece

    path = queries.vocabulary("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    df = odd_docs(llm).unionByName(llm.read.parquet(f"{SMALL}/documents.parquet").withColumns({"score": F.lit(0.1), "ids": F.lit("y")}))
    rows = pieces.encode_decode(df, path).collect()
    assert len(rows) == df.count()
    for r in rows:
        want = lib.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["decoded"] == lib.decode(want)
    assert pieces.encode_decode(df.limit(0), path).count() == 0


def test_every_text_is_held_against_the_library():
    with open(queries.vocabulary("piece_bpe_32k.model"), "rb") as f:
        own = pieces.Codec(f.read())
    some = ["the first", "the second", "a third"]
    ids = own.encode(some)
    decoded = [own.decode(i) for i in ids]
    own.check(some, ids, decoded)
    with pytest.raises(ValueError, match="the second"):
        own.check(some, [ids[0], ids[0], ids[2]], decoded)
    with pytest.raises(ValueError, match="a third"):
        own.check(some, ids, [*decoded[:2], ""])


def test_texts_of_odd_spaces_encode_like_the_library():
    with open(queries.vocabulary("piece_bpe_32k.model"), "rb") as f:
        own = pieces.Codec(f.read())
    rng = np.random.default_rng(6)
    parts = ["a", "the", "Straße", "日本", "\u2581", " ", "  ", "\n", "\n\n", "\t", "x" * 40, ".", "\r\n"]
    some = ["".join(rng.choice(parts, rng.integers(0, 9))) for _ in range(3000)] + [" ".join(rng.choice(parts, 6)) for _ in range(500)]
    ids = own.encode(some)
    own.check(some, ids, [own.decode(i) for i in ids])


def test_many_texts_are_encoded_and_held_against_the_library_at_once(monkeypatch):
    with open(queries.vocabulary("piece_bpe_32k.model"), "rb") as f:
        own = pieces.Codec(f.read())
    merged, asked = [], []
    rows, library = pieces.merged_rows, own.library

    class Library:
        def __getattr__(self, name):
            asked.append(name)
            return getattr(library, name)

    monkeypatch.setattr(pieces, "merged_rows", lambda flat, lengths, pairs: merged.append(len(lengths)) or rows(flat, lengths, pairs))
    own.library = Library()
    some = ["", "one two\ntwo", "\u2581two  \U00010400\u0bf5 one", "", "\n\n", " ", "a\r\nb\t" + "x" * 90] * 50
    ids = own.encode(some)
    decoded = own.decode_many(ids)
    own.check(some, ids, decoded)
    assert merged == [len({p for t in some if t for p in re.findall(r"\n| *[^ \n]+| +", " " + t.replace("\u2581", " "))})]
    assert sorted(asked) == ["decode", "encode"]
    assert decoded == [own.decode(i) for i in ids] == [library.decode(library.encode(t, add_bos=True, add_eos=True)) for t in some]
    assert own.encode([]) == own.decode_many([]) == []


def test_ids_that_show_no_text_decode_like_the_library():
    with open(queries.vocabulary("piece_bpe_32k.model"), "rb") as f:
        own = pieces.Codec(f.read())
    rng = np.random.default_rng(3)
    some = [[], [1], [1, 2], [0], [1, 0, 300], *(rng.integers(0, own.size, n).tolist() for n in range(1, 40)), *(rng.integers(0, 300, n).tolist() for n in range(1, 40))]
    assert own.decode_many([np.array(i, dtype="<u4").tobytes() for i in some]) == [own.library.decode(i) for i in some]


@pytest.mark.parametrize("n", [0, 1, 3, 5000])
def test_pairs_are_found_as_in_the_dictionary(n):
    rng = np.random.default_rng(n)
    entries = {(a, b): (k, a + b) for k, (a, b) in enumerate(rng.integers(0, 1 << 20, (n, 2)).tolist())}
    pairs = Pairs(entries)
    left, right = np.vstack([np.array([*entries], dtype=np.int64).reshape(-1, 2), rng.integers(0, 300, (1000, 2))]).T
    rank, merged = pairs.find(left, right)
    for a, b, r, m in zip(left.tolist(), right.tolist(), rank.tolist(), merged.tolist(), strict=True):
        assert (r, m) == entries[a, b] if (a, b) in entries else r == NONE


def test_a_null_id_has_no_class_even_beside_a_copy(llm):
    df = frame(llm, [{"doc_id": 5, "text": "one two three four"}, {"text": "one two three four"}, {"doc_id": 9, "text": "one two three four"}])
    assert sorted(((r["id"] or 0), r["root"]) for r in neardup.near_duplicates(df, 3, 85).collect()) == [(0, None), (5, 5), (9, 5)]


def test_quality_weights_do_not_hang_on_partitions(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = llm.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    one, other = quality.fit(docs.coalesce(1), labels.coalesce(1)), quality.fit(docs.repartition(7), labels.repartition(5))
    assert one["w"] == pytest.approx(other["w"], rel=1e-6) and one["threshold"] == pytest.approx(other["threshold"], rel=1e-6)


def test_pipeline_stages_of_an_empty_table(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(llm, docs, SMALL)
        assert docs.count() == 0, name
    assert corpus_pipeline.STAGES[3][1](llm, docs, SMALL).count() == 0


def test_both_agendas_agree():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        own = packing.WordCodec(f.read())
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 20, 39, 60):
        for _ in range(20):
            raw = rng.integers(97, 123, n).astype(np.uint8)
            flat = own.inner[raw]
            assert merged_words(flat, np.array([n]), own.pairs, lambda r: r.tolist())[0] == merge(flat.tolist(), own.pairs)


def test_packing_covers_each_token_once(llm):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    df = odd_docs(llm).unionByName(llm.read.parquet(f"{SMALL}/documents.parquet").withColumns({"score": F.lit(0.1), "ids": F.lit("y")}).filter("doc_id >= 20"))
    rows = packing.pack(packing.tokenise(df, path)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for r in df.collect():
        own = sorted(by[r["doc_id"]], key=lambda x: x["start"])
        ids = np.frombuffer(b"".join(x["ids"] for x in own), "<u4").tolist()
        assert ids == lib.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        assert {x["doc_tokens"] for x in own} == {len(ids)} and [x["start"] for x in own] == list(np.cumsum([0] + [x["length"] for x in own])[:-1])
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        own.sort()
        assert [a for a, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1]) and sum(n for _, n in own) <= 4096
    assert sum(r["length"] for r in rows) > 0.97 * 4096 * len(sequences)
    assert packing.pack(packing.tokenise(df.limit(0), path)).count() == 0


def test_hot_length_is_packed_in_salted_groups(llm):
    table = llm.range(3000).select("id", F.when(F.col("id") % 3 < 2, 100).otherwise(F.col("id") % 4096 + 1).cast("long").alias("length"))
    rows = packing.pack(table, group_rows=50).collect()
    assert len(rows) == 3000 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 3000
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 4096 and sum(used.values()) / (4096 * len(used)) > 0.98


def test_plan_uses_each_piece_once():
    rng = np.random.default_rng(0)
    for window, n in ((64, 500), (4096, 20_000), (100, 7)):
        counts = Counter(np.minimum(rng.geometric(5 / window, n), window).tolist())
        patterns = packing.plan(dict(counts), window, bins=32)
        used = Counter()
        for pattern, repeat in patterns:
            assert sum(pattern) <= window and repeat > 0
            for length in pattern:
                used[length] += repeat
        assert used == counts


VECTORS = "vec_id long, embedding array<float>, label int, id string, v string"


def vectors(spark, n=300):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 8)).astype(np.float32)
    x[40:90] = x[40]  # ties
    rows = [{"vec_id": i, "embedding": x[i].tolist(), "id": "a"} for i in range(n)]
    odd = [{"vec_id": 1000, "embedding": None}, {"vec_id": 1100, "embedding": [float("nan")] * 8}, {"vec_id": 1200, "embedding": [None] * 8}, {"vec_id": 1300, "embedding": [float("inf")] + [0.0] * 7}, rows[0], rows[45]]
    return frame(spark, rows + odd, VECTORS), x


@pytest.mark.parametrize("shard", [64, 8192])
def test_exact_top_k(llm, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    df, x = vectors(llm)
    whole = np.floor(1024 * x.astype(np.float64)).astype(np.int64)
    want = []
    for q in range(0, len(x), 100):
        s = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:10]
        want += [(q, k + 1, int(i), int(s[i])) for k, i in enumerate(order)]
    got = topk.search(df, F.col("id") % 100 == 0, 10).collect()
    assert sorted(tuple(r) for r in got) == want
    assert topk.search(df.limit(0), F.col("id") % 100 == 0, 10).count() == 0
    assert len(topk.search(df.filter("vec_id < 4"), F.col("id") % 100 == 0, 10).collect()) == 3


@pytest.mark.parametrize("factor", [1.0, 1.5])
def test_vantage_point_trees(llm, monkeypatch, factor):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 100)
    df, x = vectors(llm)
    df = df.unionByName(frame(llm, [{"vec_id": 1400, "embedding": [0.0] * 8}], VECTORS))
    x = x.astype(np.float64)
    hit = total = 0
    rows = vptree.search(df, F.col("id") % 20 == 0, 20, factor).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(by) == list(range(0, len(x), 20))
    for q, own in by.items():
        s = (x * x[q]).sum(1)
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:20]
        assert [v for v, _ in own] == sorted([v for v, _ in own], key=lambda v: (-s[v], v))
        assert np.allclose([v for _, v in own], [s[v] for v, _ in own], rtol=0, atol=1e-12)
        hit += len({v for v, _ in own} & set(order))
        total += 20
    assert hit == total if factor == 1 else hit >= 0.9 * total
    assert vptree.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("most", [4.0, 1e5])
def test_uneven_norms_lose_no_neighbours(llm, most):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 16))
    x *= rng.uniform(0.1, 1, len(x))[:, None] / np.sqrt((x * x).sum(1))[:, None]
    x[700] *= most / np.sqrt((x[700] ** 2).sum())
    x = x.astype(np.float32)
    df = frame(llm, [{"vec_id": i, "embedding": v.tolist()} for i, v in enumerate(x)], VECTORS)
    got = {}
    for r in vptree.search(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    x = x.astype(np.float64)
    for q in range(0, len(x), 20):
        s = (x * x[q]).sum(1)
        assert got[q] == [int(i) for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:20]


def test_recall_on_the_embeddings(llm):
    got = {(r["query_id"], r["vec_id"]) for r in queries.QUERIES["op9_vptree"](llm, SMALL).collect()}
    rows = llm.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    right = set()
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        right |= {(int(ids[k]), int(i)) for i in ids[np.lexsort((ids, -s))[:20]]}
    assert len(got & right) >= 0.9 * len(right)


def test_page_text_without_templates(llm):
    menu = "<div><ul><li>Home</li><li>About</li></ul></div>"
    rows = [{"page_id": i, "url": f"http://h.example/{i}", "html": f"<html><body>{menu}<p>Text {i} &amp; more<p>Next  <b>bo</b>ld<br>{i}</p><footer>f</footer><div class='comments'>no</div></body>"} for i in range(8)]
    rows += [{"page_id": 100, "url": "http://other.example/", "html": f"{menu}<p>only"}]
    rows += [{"page_id": 101 + i, "url": "http://a.example/", "html": f"<nav>n</nav><article><h1>T{i}</h1><p>same</p><form>f</form></article><p>out"} for i in range(6)]
    rows += [{"page_id": 200, "url": None, "html": None}, {"page_id": 201, "url": "x", "html": ""}, {"page_id": 202, "url": "x", "html": "<article>cut &lt;off <b"}, {"page_id": 202, "url": "x", "html": "<div>" * 5000 + "deep"}]
    df = frame(llm, [r | {"text": "t", "host": "h"} for r in rows], "page_id long, url string, html string, text string, host string, template string")
    got = {}
    for r in pages.extract(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    for i in range(8):
        assert got[i] == [f"Text {i} & more\nNext bold {i}"]
    assert got[100] == ["Home\nAbout\nonly"] and got[103] == ["T2\nsame"]
    assert got[200] == [""] and got[201] == [""] and sorted(got[202]) == ["cut <off", "deep"]
    assert pages.extract(df, broadcast_entries=-1).count() == len(rows)
    assert pages.extract(df.limit(0)).count() == 0


def test_copies_of_a_page_are_no_template(llm):
    menu = "<div><ul><li>Home</li></ul></div>"
    rows = [(i, "http://copies.example/", f"<html><body><div>{menu}<article><p>one</p></article></div><p>out</p>") for i in range(6)]
    rows += [(10 + i, f"http://plain.example/{i}", f"<html><body><div><p>a page<p>served again</div><script>var n={i}</script>") for i in range(6)]
    rows += [(20 + i, "http://mixed.example/", f"<html><body>{menu}<div><p>text {min(i, 4)}</p></div>") for i in range(30)]
    rows += [(60 + i, f"http://near.example/{i}", f"<html><body><p>at {i}</p><div><article><p>all have it</p></article></div>") for i in range(6)]
    got = {r["page_id"]: r["text"] for r in pages.extract(frame(llm, [dict(zip(("page_id", "url", "html"), r, strict=True)) for r in rows], "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert {got[i] for i in range(6)} == {"one"} and {got[10 + i] for i in range(6)} == {"a page\nserved again"}
    assert [got[20 + i] for i in range(30)] == [f"text {min(i, 4)}" for i in range(30)]
    assert {got[60 + i] for i in range(6)} == {"all have it"}


def test_templates_of_small_and_of_varied_hosts(llm):
    menu = "<div><ul><li>Home</li></ul></div>"
    rows = [(i, f"http://two.example/{i}", f"<body>{menu}<p>text {i} of a page") for i in range(2)]
    rows += [(10 + i, f"bare{i % 3}.example/{i}", f"<body><div><ul><li>Home {i % 3}</li></ul></div><p>text {i} of a page") for i in range(15)]
    rows += [(100 + i, f"http://large.example/{i}", f"<body>{menu}<div><p>section {i % 6}</div><p>text {i} of a page that is a little longer") for i in range(180)]
    rows += [(300 + i, f"http://near.example/{i}", f"<body><p>{'all the same text ' * 20}</p><p>at {i}") for i in range(8)]
    rows += [(320 + i, f"http://both.example/{i}", f"<body>{menu}<p>{'all the same text ' * 20}</p><p>at {i}") for i in range(8)]
    rows += [(330 + i, f"http://both.example/{i}", f"<body>{menu}<p>text {i} of a page") for i in range(5)]
    got = {r["page_id"]: r["text"] for r in pages.extract(frame(llm, [dict(zip(("page_id", "url", "html"), r, strict=True)) for r in rows], "page_id long, url string, html string")).collect()}
    same = ("all the same text " * 20).strip()
    for i in range(2):
        assert got[i] == f"text {i} of a page"
    for i in range(15):
        assert got[10 + i] == f"text {i} of a page"
    for i in range(180):
        assert got[100 + i] == f"text {i} of a page that is a little longer"
    for i in range(8):
        assert got[300 + i] == got[320 + i] == f"{same}\nat {i}"
    assert [got[330 + i] for i in range(5)] == [f"text {i} of a page" for i in range(5)]


def test_pages_of_the_table(llm):
    def article(html):
        import html as entities

        body = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(?:</article>|$)", html, re.S)[1])
        some = [" ".join(entities.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        return "\n".join(b for b in some if b)

    html = {r["page_id"]: r["html"] for r in llm.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in queries.QUERIES["op4_html"](llm, SMALL).collect():
        assert r["text"] == article(html[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_quality_on_held_out_rows(llm):
    labels = {r["doc_id"]: r["quality"] for r in llm.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op5_quality"](llm, "/root/testdata/sf0.01").collect()]
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


def test_quality_odd_rows(llm):
    docs = odd_docs(llm)
    some = llm.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    rows = quality.scored(docs, quality.fit(docs, some)).collect()
    assert len(rows) == 10 and all(math.isfinite(r["score"]) for r in rows) and rows[0]["text"] is None
    one = quality.fit(docs, some.filter("quality = 1"))
    assert all(r["score"] == pytest.approx(0.7) for r in quality.scored(docs, one).collect())
    assert quality.scored(docs.limit(0), one).count() == 0


def test_quality_threshold_is_that_of_all_labelled_rows(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = llm.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    model = quality.fit(docs, labels, bound=60)
    rows = quality.described(docs.join(labels, "doc_id")).select("quality", quality.strength_of(model["w"]).alias("s")).toPandas()
    q = float((rows["quality"] == 0).mean())
    low, threshold, high = np.quantile(rows["s"], [q / 2, q, (1 + q) / 2])
    assert len(rows) > 120 and model["threshold"] == pytest.approx(threshold) and model["spread"] == pytest.approx((high - low) / 6)
    labelled = {r["doc_id"]: r["s"] for r in quality.all_strengths(docs, labels, len(rows), model["w"], broadcast_rows=0).collect()}
    assert sorted(labelled.values()) == sorted(rows["s"])


def test_language_on_held_out_rows(llm):
    truth = {r["doc_id"]: r["lang"] for r in llm.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op10_language"](llm, "/root/testdata/sf0.01").collect()
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_small_languages_keep_their_words(llm):
    rng = np.random.default_rng(11)
    large = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(40)]
    small = ["pqrs", "tuvw", "rstu", "wvpq", "uqtp", "vwrs"]
    rows = [{"doc_id": i, "lang": f"l{i % 3}", "text": " ".join(rng.choice(large, 30))} for i in range(120)]
    rows += [{"doc_id": 200, "lang": "small", "text": " ".join(small)}]
    rows += [{"doc_id": 300 + i, "text": w} for i, w in enumerate([*small, "sp", "tuvwx"])]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame(llm, rows), F.col("doc_id") < 300, words=20, grams=20).collect()}
    assert [got[300 + i] for i in range(8)] == ["small"] * 8


def test_language_odd_rows(llm):
    rows = {r["doc_id"]: r for r in langid.identify(odd_docs(llm), F.lit(True)).collect()}
    assert [rows[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and rows[3]["lang_pred"] == "en" and rows[0]["score"] == 0
    nothing = langid.identify(odd_docs(llm), F.lit(False)).collect()
    assert len(nothing) == 10 and {r["lang_pred"] for r in nothing} == {"und"}


def brute_lm(texts, train):
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in texts.items()}
    counts = Counter(w for i in tokens if train[i] for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)) for i, t in tokens.items()}


def test_language_model_reaches_the_driver_as_kept_columns(llm, monkeypatch):
    """Top words and n-grams are picked on the executors; the driver gets no row but the kept ones, as Arrow columns."""
    frames, plans = type(llm.range(1)), []
    arrow, collect = frames.toArrow, frames.collect

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return arrow(df)

    def few(df):
        rows = collect(df)
        assert len(rows) <= 6
        return rows

    monkeypatch.setattr(frames, "toPandas", lambda df: pytest.fail("rows of the model as objects"))
    monkeypatch.setattr(frames, "toArrow", seen)
    monkeypatch.setattr(frames, "collect", few)
    texts = [("de", "das haus und der hund"), ("de", "der baum"), ("en", "the house and the dog"), ("en", "the tree"), ("en", None), (None, "le chien")]
    model = langid.fit(frame(llm, [{"doc_id": i, "lang": lang, "text": t} for i, (lang, t) in enumerate(texts)]), words=4, grams=7)
    assert model["langs"] == ["de", "en"]
    assert len(plans) == 1 and not re.search("Sort|Limit", plans[0])
    at = {}
    for kind in range(6):
        counts = {lang: Counter(g for own, t in texts if own == lang for w in (t or "").split() for g in ([w] if kind == 0 else langid.ngrams(w, kind))) for lang in model["langs"]}
        every = sorted(set().union(*counts.values()), key=lambda g: (-max(c[g] / c.total() for c in counts.values()), g))
        grams, rows = model["grams"][kind]
        assert isinstance(grams, pa.Array) and sorted(grams.to_pylist()) == sorted(every[: 7 if kind else 4])
        for g, row in zip(grams.to_pylist(), rows, strict=True):
            at[int(row)] = [math.log((c[g] + langid.ALPHA) / (c.total() + langid.ALPHA * len(every))) for c in counts.values()]
    assert sorted(at) == list(range(len(model["table"])))
    np.testing.assert_allclose(model["table"], [at[k] for k in range(len(at))], rtol=1e-6)


def test_language_model_of_texts_without_letters(llm):
    model = langid.fit(frame(llm, [{"doc_id": i, "lang": "en", "text": "12 3"} for i in range(2)]))
    assert model["langs"] == ["en"] and model["table"].shape == (0, 1) and [len(g) for g, _ in model["grams"]] == [0] * 6
    assert langid.Scorer(model).score(["one", "1"])[0] == ["en", "und"]


def test_language_model_counts_and_gain(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    train = {i: zlib.crc32(str(i).encode()) % 7 != 2 for i in texts}
    want = brute_lm(texts, train)
    rows = queries.QUERIES["op6_language_model"](llm, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, not train[r["doc_id"]])
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


class BruteMixture:
    """Deleted interpolation by dictionaries of word tuples; weights from the same fit, events counted anew."""

    def __init__(self, texts, train, deleted):
        self.texts = {i: ["<", "<", *(t or "").lower().split(), ">"] for i, t in texts.items()}
        train, deleted = {i for i in texts if train(i)}, {i for i in texts if train(i) and deleted(i)}
        self.whole, self.rest = self.counts(train), self.counts(train - deleted)
        self.vocabulary = {g[0] for g in self.whole if len(g) == 1} - {"<"}
        seen = Counter()
        for i in deleted:
            for k in range(2, len(self.texts[i])):
                bucket, *ps, p0 = self.estimates(self.rest, self.texts[i][k - 2 : k + 1])
                seen[bucket, *(round(lm.GRID * math.log(p / p0)) + 500 if p else -1 for p in ps)] += 1
        self.weights = lm.weights(pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["bucket", "triple", "pair", "word", "n"]))

    def counts(self, ids):
        out = Counter()
        for i in ids:
            t = self.texts[i]
            out["<",], out["<", "<"] = out["<",] + 1, out["<", "<"] + 1
            for k in range(2, len(t)):
                out.update([tuple(t[k - 2 : k + 1]), ("pair", *t[k - 1 : k + 1]), tuple(t[k : k + 1])])
        return Counter({(g[1:] if g[0] == "pair" and len(g) == 3 else g): n for g, n in out.items()})

    def estimates(self, c, gram):
        a, b, w = gram
        n = sum(v for g, v in c.items() if len(g) == 1 and g != ("<",))
        two, one = c[a, b], c[b,]
        exact = lambda x: x if x <= 8 else min(63, 9 + math.floor(2 * math.log2(x / 9)))
        return 64 + exact(two) if two else exact(one), c[a, b, w] / two if two else 0, c[b, w] / one if one else 0, c[w,] / max(n, 1), 1 / (len(self.vocabulary) + 1)

    def p(self, gram):
        bucket, *ps = self.estimates(self.whole, gram)
        return float(np.dot(self.weights[bucket], ps))


def lm_texts():
    rng = np.random.default_rng(17)
    words = [f"w{k}" for k in range(14)]
    texts = {i: " ".join(rng.choice(words, rng.integers(0, 15))) for i in range(40)}
    return texts | {50: None, 51: "", 52: "W1 w2 w3 " * 12, 53: "w1 w2 w3 " * 12, 54: "new words w1 only", 60: texts[3], 61: texts[3]}


def test_language_model_score_is_the_brute_force_mixture(llm):
    texts = lm_texts()
    brute = BruteMixture(texts, lambda i: i % 5 != 0, lambda i: i % 5 == 1)
    got = {r["id"]: r["score"] for r in lm.score(frame(llm, [{"doc_id": i, "text": t} for i, t in texts.items()]), F.col("doc_id") % 5 != 0, F.col("doc_id") % 5 == 1).collect()}
    assert set(got) == set(texts)
    for i, t in brute.texts.items():
        assert got[i] == pytest.approx(sum(math.log10(brute.p(t[k - 2 : k + 1])) for k in range(2, len(t))), abs=1e-6)
    for a, b in [("<", "<"), ("<", "w1"), ("w1", "w2"), ("w3", "nowhere"), ("nowhere", "w3"), ("w9", "w9"), ("new", "words")]:
        assert sum(brute.p((a, b, w)) for w in [*brute.vocabulary, "unseen word"]) == pytest.approx(1)


def test_language_model_exchange_by_levels(llm, monkeypatch):
    def scored(df):
        return sorted((r["id"], r["n_known"], round(r["score"], 9)) for r in lm.score(df, F.col("doc_id") % 5 != 0, F.col("doc_id") % 5 == 1).collect())

    docs = frame(llm, [{"doc_id": i, "text": t} for i, t in lm_texts().items()]).repartition(3)
    plain = scored(docs)
    cells, keep = [], lm.kept

    def counted(df, tag):
        out = keep(df, tag)
        cells.append((tag, out.count()))
        return out

    monkeypatch.setattr(lm, "FAN", 2)
    monkeypatch.setattr(lm, "PART_TOKENS", 16)
    monkeypatch.setattr(lm, "kept", counted)
    assert scored(docs) == plain and [t for t, _ in cells].count("cells") >= 2

    for bits, texts in ((5, 48), (6, 96)):  # twice the texts, blocks and parts: twice the bound, which no level passes
        cells.clear()
        df = frame(llm, [{"doc_id": i, "text": " ".join(f"x{i}y{k}" for k in range(20))} for i in range(texts)]).repartition(texts // 4)
        blocks = lm.packed(df, F.lit(True), F.lit(False), "doc_id", "text")
        _, types = lm.exchanged(lm.cells(blocks, 0, 2, bits - 2), bits, 2)
        assert types == 20 * texts + 1 and len(cells) == 2 * -(-bits // 2) - 1
        assert max(n for _, n in cells) <= 1 << (bits + 2)


def test_language_model_odd_texts(llm):
    texts = ["a b a c", "b a", "c", None, "a b"]
    probes = frame(llm, [{"doc_id": i, "text": t} for i, t in enumerate(texts)] + [{"doc_id": 100 + i, "text": f"a {w}"} for i, w in enumerate(["a", "b", "c", "unseen"])])
    rows = {r["id"]: r for r in lm.score(probes, F.col("doc_id") < 100, F.col("doc_id") == 4).collect()}
    assert rows[3]["n_tokens"] == 1 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows.values())
    assert lm.score(probes.limit(0), F.lit(True), F.lit(False)).count() == 0
    none = lm.score(probes, F.lit(False), F.lit(False)).collect()
    assert len(none) == len(rows) and {(r["train_tokens"], r["score"]) for r in none} == {(0, 0.0)}


def test_mixture_weights_are_those_of_the_events():
    w = lm.weights(pd.DataFrame({"bucket": [70, 70, 3], "triple": [540, -1, -1], "pair": [500, 500, 510], "word": [500, 500, 500], "n": [90, 10, 5]}))
    assert np.allclose(w.sum(1), 1) and w[70, 0] > 0.85 and (w[64:] > 0).all()
    assert (w[:64, 0] == 0).all() and (w[0, :2] == 0).all() and (w[1:64, 1:] > 0).all()


def test_chat_round_trip(llm):
    said = "</s>[INST] ok [/INST] \\e \\ <s>"
    turns = [(1, 0, "system", "s"), (1, 1, "user", said), (1, 2, "assistant", said), (1, 3, "user", None), (1, 4, "assistant", "é😀"), (2, 0, "user", "alone"), (3, 0, "assistant", ""), (3, 0, "assistant", ""), (None, 1, None, "x")]
    df = llm.createDataFrame([(*t, "e", 1) for t in turns], "conv_id long, turn long, role string, text string, example string, n int")
    rows = {r["conv_id"]: r for r in chat.digests(df).collect()}
    by = {}
    for c, _, role, text in turns:
        by.setdefault(c, []).append((role or "", text or ""))
    for c, own in by.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert rows[c]["n_turns"] == len(own) and rows[c]["loss_chars"] == len(loss)
        assert rows[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert rows[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    made = chat.examples(df).filter("conv_id = 1").orderBy("example").collect()
    assert [(r["turns"], r["whole"]) for r in made] == [(3, False), (5, True)]
    assert made[1]["formatted"].count("<s>") == made[1]["formatted"].count("</s>") == 5
    assert made[1]["formatted"][made[1]["loss_start"] : made[1]["loss_end"]] == "é😀"
    assert chat.digests(df.limit(0)).count() == 0


def test_pipeline_stages(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "packing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, now, SMALL)
        if name == "packing":
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in now.select("doc_id").collect()}
            continue
        assert out.columns == docs.columns
        rows = out.collect()
        if name == "near_duplicates":
            classes = brute_classes({r["doc_id"]: r["text"] for r in now.collect()}, 5, 80)
            assert sorted(r["doc_id"] for r in rows) == sorted(i for i, (_, root) in classes.items() if i == root)
        now = llm.createDataFrame(rows, docs.schema)


def test_filtering_stages_keep_clashing_columns(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet").withColumns({c: F.lit("own") for c in ("lang_pred", "score", "predicted")})
    for _, stage in corpus_pipeline.STAGES[:2]:
        out = stage(llm, docs, SMALL)
        assert out.columns == docs.columns
        assert [tuple(r) for r in out.select("lang_pred", "score", "predicted").distinct().collect()] == [("own",) * 3]


def test_shared_folder_is_asked_for_on_a_cluster(llm, monkeypatch):
    from foldwise.llm import common

    class Bare:
        conf = llm.conf

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    if llm.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_dir(Bare)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(llm, duck, name):
    from tools.oracle_check import frame_hash

    assert frame_hash(queries.QUERIES[name](llm, SMALL).toPandas()) == frame_hash(duck.execute(queries.SQL[name]).df())


KEPT_WHOLE = [
    '<div class="page with-sidebar"><article><p>own text</p></article></div>',
    '<div id="content" class="no-sidebar"><p>own text</p></div>',
    '<div class="layout has-menu"><article>own text</article></div>',
    '<form id="aspnetForm"><nav>n</nav><article>own text</article></form>',
    '<form id="aspnetForm"><p>own text</p></form>',
    '<div class="sidebar-layout"><div class="menu">m</div><main>own text</main></div>',
    '<article><p class="share price">own</p> <div class="alert alert-info">text</div></article>',
    '<article><h1 class="banner">own</h1><section class="related work">text</section></article>',
    '<article>own <math><mi>text</mi></math></article>',
    '<div role="main">own text</div><p>outside</p>',
    '<main>own text</main><article>a teaser</article><div class="related"><article>another</article></div>',
    '<div class="related"><article>a teaser</article></div><article>own text</article>',
    '<aside><article>a teaser</article></aside><div class="widget"><article>own text</article></div>',
    '<article><header>own</header>text<footer>f</footer><div class="share-buttons">s</div><form>f</form></article>',
    '<nav>n</nav><div class="comments">c</div><p>own text</p><div class="cookie-banner">ok</div>',
    '<aside><article>own text</article></aside>',
    '<article>own <div class="sidebar">s</div><div class="nav menu">m</div>text</article>',
    '<article></article><p>own text</p>',
    '<body class="has-sidebar"><div class="sidebar">s</div><p>own text of some length</p></body>',
]


def test_no_article_is_lost_to_names_and_classes(llm):
    rows = [{"page_id": i, "url": f"http://h{i}.example/", "html": h} for i, h in enumerate(KEPT_WHOLE)]
    got = {r["page_id"]: r["text"] for r in pages.extract(frame(llm, rows, "page_id long, url string, html string")).collect()}
    for i, h in enumerate(KEPT_WHOLE):
        assert " ".join(got[i].split()) in ("own text", "own text of some length"), (h, got[i])


def test_template_counts_equal_a_recount(llm):
    """The subtrees counted in Spark against a plain count over each host's distinct pages."""
    from urllib.parse import urlsplit

    table = llm.read.parquet(f"{SMALL}/pages.parquet")
    limits = {"least": 5, "share": 0.5, "many": 20, "low_share": 0.05, "inner_share": 0.6}
    found = {r["host"]: dict(r["template"]) for r in pages.templates(table, 0.1, 50_000, "html", "url", **limits).collect()}
    hosts = {}
    for r in table.collect():
        order = pages.hashed(pages.tree(r["html"] or ""))
        hosts.setdefault((urlsplit(r["url"] or "").hostname or "").lower(), {})[order[0][0].key] = (order[0][0].size, pages.candidates(order))

    def often(trees):
        n, count = len(trees), Counter(k for _, c in trees for k in set(c[0]))
        keep = lambda c: c >= n and n > 1 if n < 5 else c >= 5 and c >= 0.5 * n or c >= 20 and c >= 0.05 * n
        return {k: c >= 5 and c >= 0.6 * n for k, c in count.items() if keep(c)}

    want = {}
    for host, trees in hosts.items():
        first = set(often(list(trees.values())))
        apart = [t for t in trees.values() if t[0] > 0 and pages.left(t[0], t[1], first) >= 0.1 * t[0]]
        if second := often(apart):
            want[host] = second
    assert found == want


def test_a_tree_learns_how_far_it_may_prune(llm):
    """Tight clusters: a part of the rows is compared, and 0.9 of the neighbours are found; uneven norms: exact."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(60, 16))
    x = (centres[rng.integers(0, 60, 6000)] + 0.05 * rng.normal(size=(6000, 16))).astype(np.float32)
    x /= np.sqrt((x * x).sum(1))[:, None]
    df = frame(llm, [{"vec_id": i, "embedding": v.tolist()} for i, v in enumerate(x)], VECTORS)
    rows = vptree.search(df, F.col("id") % 20 == 0).collect()
    got, share = {}, max(r["share"] for r in rows)
    for r in rows:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    x = x.astype(np.float64)
    hit = 0
    for q in range(0, 6000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(got[q] & set(np.argsort(-s, kind="stable")[:20].tolist()))
    assert hit >= 0.9 * 20 * 300 and share < 0.5, (hit, share)
    exact = vptree.search(df, F.col("id") % 20 == 0, factor=1.0).collect()
    assert len(exact) == 6000


@pytest.mark.parametrize("search", [topk.search, vptree.search])
def test_vectors_of_unequal_lengths_are_named(llm, search):
    df = frame(llm, [{"vec_id": 0, "embedding": [1.0, 2.0]}, {"vec_id": 20, "embedding": [1.0]}], VECTORS)
    with pytest.raises(ValueError, match="1 and of 2 components"):
        search(df, F.col("id") % 20 == 0)
