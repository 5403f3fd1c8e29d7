"""Text operators against brute force, round trips and edge cases on small fixtures."""

import collections
import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridgeline.llm import bpe, chat, minhash, mixing, pii, pseudo_likelihood, quality, sstable, topk, url_rules

TABLES = "/root/testdata/sf0.01"
KIND = "doc_id long, text string, lang string, source string, n_chars long, id long, mark string, size long, `_id` long, `_mark` long"


def documents(spark, rows):
    """Rows of (doc_id, text[, source]) with further columns whose names operators use themselves."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 1, "m", 2, 3, 4) for r in rows]
    return spark.createDataFrame(full, KIND)


WORDS = [a + b + c for a in "bdfglm" for b in "aeiou" for c in ("n", "r", "st", "")]


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


def edited(text, seed, n):
    draw, words = random.Random(seed), text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = draw.choice(WORDS)
    return " ".join(words)


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (None, "no id here"), (5, prose(1, 9000)), (6, "twin row"), (6, "twin row"), (7, "twin row", None)]
    return documents(spark, rows)


def clusters(texts, words, percent):
    sets = {}
    for i, t in texts.items():
        w = [x.lower() for x in (t or "").encode().split()]
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, words, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)  # many blocks even here
    texts = {i: prose(i, 60) for i in range(40)}
    base = prose(999, 200)
    texts |= {100 + k: edited(base, k, k % 12) for k in range(40)}
    texts |= {200 + k: base for k in range(5)} | {300: None, 301: "", 302: "a b", 303: "A b"}
    found = minhash.near_duplicates(documents(spark, list(texts.items())), words=words, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == clusters(texts, words, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_trees_join_the_members_of_a_bucket_by_small_parts(spark):
    members = spark.createDataFrame([(7, i, 0) for i in range(2000)] + [(8, 5000, 5000), (8, 5009, 5000)], "bucket long, id long, lead long")
    pairs = [tuple(r) for r in minhash.trees(members).collect()]
    assert len(pairs) == 2000  # one less than members in each bucket
    reached = {0, 5000}
    for _ in range(2):
        reached |= {b for a, b in pairs if a in reached}
    assert reached == set(range(2000)) | {5000, 5009}
    assert max(sum(a == x for a, _ in pairs) for x in (0, 1, 2, 3)) <= minhash.PARTS + 50


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    a, b, c, d = (prose(i, 80) for i in range(4))
    rows = [
        *[(None, a)] * 5, (None, edited(a, 1, 1)),  # no ids at all
        *[(10, b)] * 4, (11, b), (None, b),  # repeated rows
        (20, c), (21, edited(c, 2, 1)), (21, d),  # one id, two texts; only one of them has a link
        (30, prose(30, 80)), (30, edited(prose(30, 80), 3, 1)),  # one id, two linked texts
        (40, ""), (40, ""), (None, None),  # no shingles
    ]
    docs = documents(spark, rows)
    found = minhash.near_duplicates(docs)
    assert found.count() == len(rows)
    stay = sorted((r.doc_id or 0, r.text or "") for r in minhash.keep_one(docs).collect())
    assert len(stay) == 8 and stay[:2] == [(0, ""), stay[1]]
    assert stay[1][1] in (a, edited(a, 1, 1)) and stay[2:5] == [(10, b), (20, c), (21, d)]
    assert stay[5][0] == 30 and stay[6:] == [(40, ""), (40, "")]
    assert sum(r.kept for r in found.collect()) == len(stay)
    assert minhash.keep_one(docs).columns == docs.columns


def test_posterior_bounds():
    for n, least in minhash.least_matches(85, 76):
        draw = np.random.default_rng(n).random((20000, n)) < 0.85
        assert (draw.sum(axis=1) < least).mean() < 1e-3
    assert minhash.bands_for(85) == 19 and minhash.bands_for(80) == 27


def test_edges_of_every_document_operator(spark, edge, tmp_path):
    none = edge.limit(0)
    gpt, clip = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
    for run in (
        minhash.near_duplicates, pseudo_likelihood.score, quality.assess, mixing.mix, pii.digest,
        lambda d: bpe.round_trip(d, gpt), lambda d: bpe.decode_ids(bpe.encode_texts(d, gpt), gpt), lambda d: sstable.encode_ordered(d, clip),
    ):
        assert run(edge).count() == 9
        assert run(none).count() == 0
    for run in (quality.keep_good, minhash.keep_one, pii.sanitize, mixing.mixed_documents):
        assert run(edge).columns == edge.columns
        assert run(none).count() == 0
        run(edge).collect()
    kept = {r.doc_id: r for r in minhash.near_duplicates(edge).collect()}
    assert (kept[1].n_shingles, kept[1].component_id, kept[1].kept) == (0, 1, True)
    assert kept[None].component_id is None and kept[None].kept
    assert kept[7].component_id == 6 and not kept[7].kept


def test_quality_counts(spark):
    window = "a b c d e f g h"
    rows = [(1, f"{window} x {window} y\nsame\nsame\n \n#|"), (2, prose(3, 100)), (3, None)]
    got = {r.doc_id: r for r in quality.assess(documents(spark, rows)).collect()}
    r = got[1]
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (21, 28, 2, 1, 16, True)
    assert got[2].kept and not got[3].kept


def test_quality_thresholds_adapt(spark):
    rows = [(i, prose(i, 80), "a") for i in range(120)] + [(500 + i, prose(i, 60) + " #" * 15, "b") for i in range(120)] + [(900, prose(7, 60) + " #" * 30, "a")]
    kept = {r.doc_id: r.kept for r in quality.assess(documents(spark, rows)).collect()}
    assert not kept.pop(900) and all(kept.values())


def test_bpe_matches_the_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(5)
    texts = ["".join(draw.choice("abcdeth ing'sé日\n\t .,0129🙂<|endoftext|>") for _ in range(draw.randrange(60))) for _ in range(300)] + ["<|endoftext|> x", "a" * 3000, ""]
    df = documents(spark, list(enumerate(texts)))
    for r in bpe.round_trip(df, public_tokenizers.path("byte_bpe_50k.json")).collect():
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_shards(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    draw = random.Random(6)
    texts = ["".join(draw.choice("abcdETH ing'sé,.İJ\u030c09\n\u0307<|startoftext|>") for _ in range(draw.randrange(80))) for _ in range(300)]
    docs = documents(spark, [(7 * i - 500, t) for i, t in enumerate(texts)])
    folder = "file://" + str(tmp_path / "shards")
    manifest = sstable.write_shards(docs.select("doc_id", "text"), path, folder)
    at = 0
    for r, text in zip(sstable.digest_shards(manifest).orderBy("doc_id").collect(), texts, strict=True):
        ids = [*lib.encode(text, add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    import pyarrow.fs as fs

    met = []
    for row in manifest.orderBy("part").collect():
        with fs.LocalFileSystem().open_input_file(row.path) as f:
            shard = sstable.ShardReader(f)
            keys = [i for i, _ in shard]
            met += keys
            assert [x.tolist() for x in shard.lookup(keys[0])] == [next(iter(shard))[1].tolist()]
            assert shard.lookup(10**9) == []
    assert met == sorted(met) and len(met) == 300


def test_url_rules(spark):
    def judge(host, path):
        fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, "allow")

    urls = ["http://a.example.com/en/x?q", "https://WWW.Example.com/en/", "http://www.example.com/fr", "http://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "http://com", "http://com/", "nothing", None, "ftp://a.b.net?/es/", "x://a.com/y://b.net/es/", "http://.com/", "http://example.com:80/en/", ""]
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    by_frame = url_rules.judge_urls(pages, url_rules.rules_frame(spark)).collect()
    for rows in (url_rules.judge_urls(pages).collect(), by_frame):
        for r in rows:
            m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
            host, path = (m[1].lower(), m[2]) if m else ("", "")
            assert (r.host, r.path) == (host, path)
            assert (r.rule, r.verdict) == judge(host, path)
    assert url_rules.judge_urls(pages.limit(0)).count() == 0


def test_nested_rules():
    sweep = url_rules.RuleSweep([("block", "a.com", "/x"), ("allow", "a.com", "/x/y"), ("block", "a.com", "/x/y/z"), ("allow", "com", "/")])
    assert [m and m[1] for m in sweep.match(["a.com"] * 4 + ["b.com"], ["/x/y/zz", "/x/yy", "/xa", "/q", "/x"])] == ["/x/y/z", "/x/y", "/x", "/", "/"]


def brute_top_k(rows, k=10):
    """(query, rank, id, score) over all pairs of one dimension, by whole numbers of any size held to a long's range."""
    held = lambda x: min(max(x, topk.LEAST), topk.MOST)
    whole = [(i, [max(min(int(np.floor(1024 * float(np.float32(x)))), 2**63 - 1), -(2**63)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for q, v in whole:
        if q % 100 == 0:
            asked[q] = min(asked.get(q, v), v)
    out = set()
    for q, v in asked.items():
        best = sorted((-held(sum(a * b for a, b in zip(v, u, strict=True))), i) for i, u in whole if i != q and len(u) == len(v))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def test_top_k_matches_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(draw.normal(size=6), 1)]) for i in range(500)]
    rows += [(500, None), (600, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (700, [float("nan")] * 6), (800, [1.0, 2.0]), (None, [1.0] * 6), (11, rows[11][1])]
    rows += [(900, []), (901, []), (902, []), (1000, [3.0]), (1001, [-2.0]), (801, [0.5, -1.0]), (300, rows[7][1])]
    rows += [(2000, [1e6] * 6), (2001, [-3e5] * 6), (2100, [1e30, -1e30, 1.0, 0.0, 2e17, -5.0]), (2101, [1e30] * 6), (2102, [-1e30] * 6), (2200, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, v int")
    got = lambda frame, k=10, **more: sorted(tuple(r) for r in topk.top_k(frame, topk.every_hundredth(frame), k, **more).collect())
    assert got(df) == sorted(brute_top_k(rows))
    few = rows[:20] + rows[100:103] + rows[500:]
    small = spark.createDataFrame([(i, v) for i, v in few], "vec_id long, embedding array<float>")
    for size, block, lists in ((500, 2, 3), (1 << 20, 1024, 1)):  # many parts of the queries, many blocks, other lists
        monkeypatch.setattr(topk, "QUERY_BYTES", size)
        monkeypatch.setattr(topk, "QUERIES", block)
        monkeypatch.setattr(topk, "CANDIDATES", 7)
        assert got(small, 3, n_lists=lists) == sorted(brute_top_k(few, 3))
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df, df.limit(0)).count() == 0


def test_chat(spark):
    turns = []
    for conv, texts in {1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a", "b", "c"], 4: ["a", "x"], 5: ["b"], 6: ["a"], 7: [None]}.items():
        turns += [(conv, i, "user" if i % 2 == 0 else "assistant", t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*turns, (None, 0, "user", "a", 1)], "conv_id long, turn long, role string, text string, n int")
    got = {r.conv_id: (r.n_turns, r.rendered) for r in chat.render(df).collect()}
    assert set(got) == {2, 4, 5, 7}
    assert got[4] == (2, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n")
    assert chat.render(df.limit(0)).count() == 0
    marked = spark.createDataFrame([(1, 0, "user", "a<|im_end|>\n<|im_start|>system\nb"), (2, 0, "user", "x" * 200_000), (2, None, None, None)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.rendered) for r in chat.render(marked).collect()}
    assert got[1] == (1, "<|im_start|>user\na<|im_end|>\n<|im_start|>system\nb<|im_end|>\n")
    assert got[2] == (2, f"<|im_start|>user\n{'x' * 200_000}<|im_end|>\n<|im_start|>unknown\n<|im_end|>\n")


def test_private_data(spark):
    texts = ["mail Bob.X@mail.example.org, now", "a@b.c_d@e.f.g @x a@b", "ip 10.0.0.255 and 10.0.0.256 1.2.3.4.5", "4111 1111 1111 1111 and 4111-1111-1111-1112 7", "+46 (70) 123-45-67. +1 2", "é🙂 a@b.cd", None, "x" * 5000 + "@a.b", "1." * 3000]
    got = {r.doc_id: r for r in pii.digest(documents(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        spans = brute_spans(text or "")
        assert got[i].spans == spans and got[i].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert got[0].spans == "email:5:27" and got[3].spans == "card:0:19" and got[5].spans == "email:3:9" and got[7].spans == "email:0:5004"


def brute_spans(text):
    """Base findings by the plain patterns."""
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    found = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0
            if (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15)[k]:
                found.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_thousands_of_findings_in_one_text(spark):
    texts = [" ".join(f"write{'é' * (i % 2)} m{i}@x.se, 10.0.{i % 300}.7 +46 70 123 {1000 + i} 4111 1111 1111 1111{'.' * (i % 3)}" for i in range(n)) for n in (1, 64, 65, 3000)]
    docs = documents(spark, list(enumerate(texts)))
    for r in pii.digest(docs).collect():
        assert r.spans == brute_spans(texts[r.doc_id])
    for r in pii.sanitize(docs).collect():
        assert r.text == brute_replaced(texts[r.doc_id])


def brute_replaced(text):
    out, at = [], 0
    for span in filter(None, brute_spans(text).split(",")):
        kind, a, b = span.split(":")
        if int(a) >= at:
            out += [text[at : int(a)], f"[{kind.upper()}]"]
        at = max(at, int(b))
    return "".join([*out, text[at:]])


def test_disclosing_terms(spark):
    rows = [(i, f"write to Kvastberg at bo@x.se {prose(i, 20)}") for i in range(5)] + [(100 + i, f"write to them at home {prose(i, 20)}") for i in range(400)]
    docs = documents(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.digest(docs).collect()}
    assert all(spans[i] == "term:9:18,email:22:29" for i in range(5)) and not any(spans[100 + i] for i in range(400))
    clean = {r.doc_id: r.text for r in pii.sanitize(docs).collect()}
    assert clean[0].startswith("write to  at [EMAIL] ") and clean[100] == rows[5][1]


def test_disclosing_terms_are_found_anywhere(spark):
    # One name always far from the address; another near it once and far elsewhere in the same document; one beside a finding.
    far = [(i, f"Kvastberg sat {prose(i, 60)} bo@x.se, Dimfors {prose(50 + i, 60)} Dimfors sat, éko@y.se") for i in range(5)]
    rows = far + [(100 + i, f"nobody sat {prose(i, 60)}") for i in range(400)] + [(600, "Kvastberg alone")]
    clean = {r.doc_id: r for r in pii.sanitize(documents(spark, rows)).collect()}
    for i in range(5):
        # Kvastberg has five of its six documents with the address, Dimfors all.
        assert clean[i].text == f"[TERM] sat {prose(i, 60)} [EMAIL],  {prose(50 + i, 60)}  sat, é[EMAIL]" and clean[i].n_chars == len(clean[i].text)
    assert clean[600].text == "Kvastberg alone" and clean[100].text == rows[5][1]


def test_mixture(spark):
    rows = [(i, prose(i, 30 + i % 50), "abcd"[min(3, i % 7)]) for i in range(200)] + [(900, "", "e"), (901, "one two", None), (5, rows_text := prose(5, 35), "a"), (5, rows_text, "a")]
    got = mixing.mix(documents(spark, rows)).collect()
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, level, left = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, {}, sum(size.values())
    free = set(order)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            break
        for s in over:
            level[s] = 3 * size[s]
            free.remove(s)
        left = sum(size.values()) - sum(level.values())
    level |= share
    for s in order:
        assert target[s] == pytest.approx(level[s]) and abs(taken[s] - target[s]) <= 0.5
    again = mixing.mix(documents(spark, rows[::-1])).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    mixed = mixing.mixed_documents(documents(spark, rows)).collect()
    assert sum(len(r.text.split()) for r in mixed) == sum(r.taken for r in got)


def test_the_mix_goes_by_the_schedule(spark):
    # Sources of very different sizes: any stretch of the output, not only the whole, has the target mix.
    rows = [(i, prose(i, 40 + i % 30), "a" if i < 900 else "b" if i < 1300 else "c") for i in range(1400)]
    docs = documents(spark, rows)
    out = [(r.source, len(r.text.split())) for r in mixing.mixed_documents(docs).collect()]
    whole = collections.Counter()
    for source, n in out:
        whole[source] += n
    for at in range(0, len(out) - 300, 100):
        met = collections.Counter()
        for source, n in out[at : at + 300]:
            met[source] += n
        assert all(abs(met[s] / met.total() - whole[s] / whole.total()) < 0.06 for s in "abc")
    # Slots of the documents ascend in the output.
    slot = {r.doc_id: r.first_slot for r in mixing.mix(docs).collect()}
    first = {}
    for k, r in enumerate(mixing.mixed_documents(docs).collect()):
        first.setdefault(r.doc_id, k)
    order = [slot[i] for i in sorted(first, key=first.get)]
    assert order == sorted(order) and set(first) == {i for i, s in slot.items() if s is not None}


def test_mixed_rows_keep_their_columns(spark):
    rows = [(1, "alpha beta", "en", "s", 10), (1, "alpha beta", "fr", "s", 10), (1, "alpha beta", "fr", "s", 10), (None, "alpha beta", None, "s", None), (None, "alpha beta", "de", "s", 1)]
    rows += [(None, "same words here", "xx", "s", 3)] * 50 + [(7, "", "en", "s", 0), (8, None, "en", "s", None), (9, "other text", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.mixed_documents(docs, block=1)
    assert mixed.columns == docs.columns
    # One source takes all that it has, so each row with words comes once, as it was.
    assert collections.Counter(tuple(r) for r in mixed.collect()) == collections.Counter(r for r in rows if r[1])


def test_blocks_grow_with_the_mix():
    assert [mixing.block_words(n) for n in (0, 1, 2**26 - 1, 2**28, 2**29, 15 * 10**12)] == [64, 64, 64, 128, 128, 4096]


def test_chunks_of_the_schedule_do_not_change_ranks(spark, monkeypatch):
    planned = mixing.plan(documents(spark, [(i, prose(i, 64), "aab"[i % 3]) for i in range(400)]).select("source", F.lit(64).cast("long").alias("size")))
    ranks = lambda: sorted(tuple(r) for r in mixing.slots(planned, 400 * 64, 64).select("slot", "source", "rank").collect())
    whole = ranks()
    monkeypatch.setattr(mixing, "CHUNK", 4)
    assert ranks() == whole and len({c for c, _, _ in whole}) > 16


def test_schedule_is_even(spark):
    rows = [(i, prose(i, 64), "ab"[i % 2]) for i in range(200)]
    planned = mixing.plan(documents(spark, rows).select("source", F.lit(64).cast("long").alias("size")))
    got = [r.source for r in mixing.slots(planned, 200 * 64, 16).orderBy("slot").collect()]
    share = got.count("a") / len(got)
    for n in range(50, len(got), 50):
        assert abs(got[:n].count("a") / n - share) < 0.1


def sample(spark):
    """Whole documents of the test tables, by id."""
    if not os.path.isdir(TABLES):
        pytest.skip("no test tables")
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect() if r.text)


def test_registered_scores_tell_gibberish_and_disorder(spark):
    draw = random.Random(1)
    rows = sample(spark)
    long = [t for _, t in rows if 100 <= len(t.split()) <= 2000 and len(set(t.split())) > 60]
    held, rows = long[::10], [r for r in rows if r[1] not in set(long[::10])]
    consonants = [" ".join("".join(draw.choice("bcdfghjklmnpqrstvwxz") for _ in range(draw.randint(3, 9))) for _ in range(120)) for _ in range(40)]
    mixed = [" ".join(draw.sample(t.split(), len(t.split()))) for t in held]
    train = documents(spark, rows).select("doc_id", "text")
    words = pseudo_likelihood.vocabulary(train)
    weights = pseudo_likelihood.train(pseudo_likelihood.tokenize(train, words), words)
    test = documents(spark, list(enumerate(held + mixed + consonants))).select("doc_id", "text")
    scores = {r.doc_id: r.per_token for r in pseudo_likelihood.apply_model(pseudo_likelihood.tokenize(test, words), words, weights).collect()}
    n = len(held)
    prose, disorder, nonsense = [scores[i] for i in range(n)], [scores[n + i] for i in range(n)], [scores[2 * n + i] for i in range(40)]
    assert max(nonsense) < sorted(prose)[n // 20]
    assert sum(a > b for a, b in zip(prose, disorder, strict=True)) > 0.6 * n
    # Nonsense inside the corpus that the query itself trains on scores low too.
    scored = {r.doc_id: r.per_token for r in pseudo_likelihood.score(documents(spark, rows + [(-1 - i, t) for i, t in enumerate(consonants)])).collect()}
    assert max(scored[-1 - i] for i in range(40)) < sorted(scored[i] for i, _ in rows)[len(rows) // 5]


def plain_scores(texts, words, weights):
    """Score by score: each conditional from its own sums, nothing shared or laid end to end."""
    net, out = pseudo_likelihood.Network(weights, words.size), []
    place = {w: i for i, w in enumerate(words.held)}
    rest = {bytes(r.word): r.share for r in words.rest.collect()}
    for text in texts:
        cut, total = (text or "").encode().lower().split(), 0.0
        token = [int(words.tokens[place[w]]) if w in place else zlib.crc32(w) % words.hashed for w in cut]
        for i, (w, t) in enumerate(zip(cut, token, strict=True)):
            around = [token[i + d] if 0 <= i + d < len(token) else words.size - 1 for d in pseudo_likelihood.PLACES]
            h = np.tanh(sum(net.embed[a, p * pseudo_likelihood.HIDDEN : (p + 1) * pseudo_likelihood.HIDDEN].astype(float) for p, a in enumerate(around)))
            for k, (unit, base) in enumerate(zip(net.units, net.bases, strict=True)):
                before = t // net.units[k - 1] if k else 0
                logits = (h * net.gate[k][before] if k else h) @ net.out[k].astype(float) + net.shift[k][before]
                total += logits[t // unit % base] - np.log(np.exp(logits).sum())
            total += float(words.shares[place[w]]) if w in place else rest.get(w, words.unmet[t])
        out.append((len(cut), total))
    return out


def test_scores_match_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "BATCH", 64)  # runs are cut inside texts
    monkeypatch.setattr(pseudo_likelihood, "HELD", 0.01)
    texts = [prose(i, 40 + i) + f" w{i}" for i in range(60)] + ["", None, "one", prose(3, 5000), " \n "]
    docs = documents(spark, list(enumerate(texts))).select("doc_id", "text")
    words = pseudo_likelihood.vocabulary(docs)
    tokenized = pseudo_likelihood.tokenize(docs, words)
    weights = pseudo_likelihood.train(tokenized, words)
    found = sorted(tuple(r) for r in pseudo_likelihood.apply_model(tokenized, words, weights).collect())
    for (_, n, total, per), (count, want) in zip(found, plain_scores(texts, words, weights), strict=True):
        assert n == count and total == pytest.approx(want, rel=1e-4, abs=1e-4) and (per is None) == (n == 0)


def test_conditional_distribution_is_normalised():
    net = pseudo_likelihood.Network()
    logs = [net.log_probability(np.array([1, 2, t, 3, 4], dtype=np.int32))[0] for t in range(net.size)]
    assert np.exp(np.array(logs, dtype=float)).sum() == pytest.approx(1, abs=1e-4)


def test_words_share_their_token_by_their_counts(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "HELD", 0.01)  # few counts are held, the others joined
    texts = [f"{'common ' * 50}w{i % 3000} {'often ' * (i % 7)}x{i // 40}" for i in range(4000)]
    docs = documents(spark, list(enumerate(texts))).select("doc_id", "text")
    words = pseudo_likelihood.vocabulary(docs)
    rest = {bytes(r.word): r.share for r in words.rest.collect()}
    met = {w for t in texts for w in t.encode().split()}
    assert set(words.held) | set(rest) == met and not set(words.held) & set(rest)
    # The shares of each hashed token's words, and of one for all words the corpus lacks, add up to 1.
    sums = np.exp(words.unmet)
    for w, share in [*zip(words.held[words.own :], words.shares[words.own :]), *rest.items()]:
        sums[zlib.crc32(w) % words.hashed] += np.exp(share)
    assert sums == pytest.approx(np.ones(words.hashed))
    # Words of one token get what their counts say, and one that was never met gets least.
    twice = next(w for w in rest if w[:1] == b"w" and texts_with(texts, w) == 2)
    once = next(w for w in rest if w[:1] == b"w" and texts_with(texts, w) == 1 and zlib.crc32(w) % words.hashed == zlib.crc32(twice) % words.hashed)
    test = documents(spark, [(0, twice.decode()), (1, once.decode()), (2, None), (2, twice.decode())]).select("doc_id", "text")
    rows = pseudo_likelihood.apply_model(pseudo_likelihood.tokenize(test, words), words, pseudo_likelihood.Network(size=words.size).weights).collect()
    scores = sorted(r.log_likelihood for r in rows)
    assert scores[3] == 0 and scores[1] == scores[2] and scores[1] - scores[0] == pytest.approx(np.log(2))


def texts_with(texts, word):
    return sum(word.decode() in t.split() for t in texts)


def test_tokens_grow_with_the_corpus(spark):
    few = documents(spark, [(0, prose(1, 500))]).select("doc_id", "text")
    many = few.crossJoin(spark.range(9000)).select("doc_id", "text")
    sizes = [pseudo_likelihood.vocabulary(d).size for d in (few, many)]
    assert sizes[0] == pseudo_likelihood.VOCABULARY and sizes[1] >= 4_500_000**0.5
    net = pseudo_likelihood.Network(size=sizes[1])
    logs = [net.log_probability(np.array([1, 2, t, 3, 4], dtype=np.int32))[0] for t in range(net.size)]
    assert len(net.bases) == 3 and np.exp(np.array(logs, dtype=float)).sum() == pytest.approx(1, abs=1e-4)


def test_pipeline_stages(spark, tmp_path):
    base = prose(50, 300)
    rows = [(i, prose(i, 150), f"s{i % 3}") for i in range(30)] + [(100, base, "s0"), (101, edited(base, 1, 3), "s1"), (200, "too short", "s0"), (201, f"{prose(77, 100)} bo@x.se", "s2")]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, "")
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs.write.parquet(str(tmp_path / str(k)))
            docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert seen[0] == {r[0] for r in rows} - {200}
    assert seen[1] == seen[0] - {101}
    private = spark.read.parquet(str(tmp_path / "2")).where("doc_id = 201").first()
    assert private.text.endswith("[EMAIL]") and private.n_chars == len(private.text)
    assert seen[4] == seen[3] <= seen[2]
