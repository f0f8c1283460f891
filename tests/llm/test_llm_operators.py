"""The training-data operators against brute force, on small and odd tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelgrain.llm import ctw, html_text, knn_join, language, minhash, near_vectors, packing, sentencepieces, substrings, toxicity
from reelgrain.llm.common import part, text_buffer, word_bounds, word_hashes
from reelgrain.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, odd white space, null and empty texts, repeated rows and null ids."""
    rng = random.Random(5)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "tu", "É", "ne") for b in ("r", "s", "ta", "ven", "x'", "ö.")]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((3, 14, 60, 200))))) for k in range(60)]
    long = rows[2][1] + " " + " ".join(rng.choice(vocabulary) for _ in range(5000))
    rows += [(100, rows[7][1]), (101, rows[7][1]), (102, rows[7][1] + " other words"), (103, "new start " + rows[9][1]),
             (104, long), (105, long.replace("kar", "kas", 3)), (106, None), (107, ""), (108, " \n\t "), (109, "one"), (110, "ONE"),
             (111, "a\x1cb c d   e"), (112, "same same same " * 40), (None, rows[7][1]), (100, rows[7][1])]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(k, t, "xx" if t and len(t) > 40 else None, "s", 1, 0) for k, t in texts], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_word_bounds_and_hashes():
    import pyarrow as pa

    raw, offsets = text_buffer(pa.array(["a bb  c\n", None, "", " x", "ab ba", "z" * 9000]))
    starts, ends, rows = word_bounds(raw, offsets)
    assert [bytes(raw[a:b])[:3] for a, b in zip(starts, ends)] == [b"a", b"bb", b"c", b"x", b"ab", b"ba", b"zzz"]
    assert rows.tolist() == [0, 3, 3, 3, 4, 6, 7]
    assert len(set(word_hashes(raw, starts, ends).tolist())) == 7


@pytest.mark.parametrize("words", [5, 13])
def test_substrings(docs, texts, words):
    split = [(2**63 - 1 if k is None else k, (t or "").encode().split()) for k, t in texts]
    first = {}
    for k, w in split:
        for i in range(len(w) - words + 1):
            g = tuple(w[i:i + words])
            first[g] = min(first.get(g, k), k)
    want = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - words + 1):
            if first[tuple(w[i:i + words])] < k:
                gone.update(range(i, i + words))
        want.append((k, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    got = [(2**63 - 1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.text) for r in substrings.without_repeats(docs, words=words).collect()]
    assert sorted(got) == sorted(want)


def test_substrings_small_groups(docs, monkeypatch):
    whole = sorted(substrings.without_repeats(docs).select("n_removed", "text").collect())
    monkeypatch.setattr(substrings, "GROUP", 3)
    monkeypatch.setattr(substrings, "PACK_BYTES", 500)
    assert sorted(substrings.without_repeats(docs).select("n_removed", "text").collect()) == whole


@pytest.mark.parametrize("words", [2, 5])
def test_minhash(docs, texts, words):
    sets = {}
    for k, t in texts:
        w = lower(t)
        sets.setdefault(k, frozenset(zip(*[w[i:] for i in range(words)])) if len(w) >= words else frozenset([tuple(w)] if w else []))
    ids = sorted(k for k in sets if k is not None)
    top = {k: k for k in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                    top[a] = top[b] = min(top[a], top[b])
    rows = minhash.near_duplicates(docs, words=words).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_shingles == len(sets[r.doc_id])
        assert (r.component_id, r.kept) == ((None, True) if r.doc_id is None else (top[r.doc_id], top[r.doc_id] == r.doc_id))


def test_minhash_chains(spark, monkeypatch):
    """Families whose members are similar to their neighbours alone, in blocks of three documents."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)
    rng = random.Random(3)
    rows, ids = [], rng.sample(range(10_000), 200)
    for family in range(4):
        for k in range(40):
            # every fourth step is too wide for a link
            first = k * 6 + k // 4 * 20
            rows.append((ids.pop(), " ".join(f"{family}w{n}" for n in range(first, first + 100))))
    rng.shuffle(rows)
    sets = {k: frozenset(zip(t.split(), t.split()[1:])) for k, t in rows}
    top = {k: k for k in sets}
    for _ in range(8):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    top[a] = top[b] = min(top[a], top[b])
    assert 4 < len(set(top.values())) < 60
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()
    assert {r.doc_id: r.component_id for r in got} == top


def test_minhash_null_ids_and_texts_of_one_id(spark):
    """A null-id row ahead of its copy, and ids with several texts, each of which has near copies."""
    text = lambda name, n=60: " ".join(f"{name}{k}" for k in range(n))
    rows = [(None, text("a")), (7, text("a")), (8, text("a") + " more")]
    rows += [(20, text("b")), (20, text("c")), (21, text("b") + " x"), (22, text("c") + " y")]
    # 31 has a copy of 30's text and one of its own, whose near copy has the smallest id of all
    rows += [(30, text("d")), (31, text("d")), (31, text("e")), (3, text("e") + " z"), (40, text("f")), (41, text("g")), (41, "")]
    want = {7: 7, 8: 7, 20: 20, 21: 20, 22: 20, 30: 3, 31: 3, 3: 3, 40: 40, 41: 41, None: None}
    for table in (rows, rows[:3] + rows[:2:-1]):
        got = minhash.near_duplicates(spark.createDataFrame(table, "doc_id bigint, text string").coalesce(1)).collect()
        assert len(got) == len(table)
        assert all(r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id] or r.doc_id is None) for r in got), got


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tokenizer, by = Tokenizer.from_file(path), {}
    rows = packing.pack(docs, path, longest=64).collect()
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.start, bytes(r.ids), r.length, r.doc_tokens, r.offset))
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.length == 1 << r.bucket and r.sequence_id // packing.BUCKET == r.bucket for r in rows)
    for k, t in texts:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        pieces = sorted(by[k])
        assert b"".join(p[1] for p in pieces) == ids.tobytes() and all(p[3] == len(ids) and p[4] == 0 for p in pieces)
        assert all(p[2] <= 64 and not p[2] & (p[2] - 1) for p in pieces)


def test_packing_ids_equal_the_library():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library, ours, rng = Tokenizer.from_file(path), packing.TextIds(path), random.Random(7)
    signs = ["a", "B", "Y", "\u030a", "\u0301", "é", "É", " ", "  ", "\n", "\xa0", "'s", "'LL", "9", "½", "<|endoftext|>", "<|ENDOFTEXT|>", "<", "İ", "\x00",
             "\x1c", "　", "...", "-", "À", "×", "÷", "ÿ", "\x0b", "~", "'"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(30))) for _ in range(5000)] + ["Y\u030a", "Y\u030a x", "3.14 it's. x..y ,a. İX.", "", None]
    texts += [" ".join("".join(rng.choices("abcXYZ'9.é", k=5)) for _ in range(2000))]
    got = ours.encode(pa.array(texts))
    assert got == [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_sentencepieces(docs, texts):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = sentencepieces.encode(docs, path).withColumn("text", sentencepieces.decoder(path)("ids")).collect()
    want = Counter((k, tuple(library.encode(t or "", add_eos=True)), library.decode(library.encode(t or ""))) for k, t in texts)
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in rows) == want
    for text in ("héllo  wörld \U0001f600x ", "▁a ▁▁b", "<0x41>", " "):
        _, begins, ends = sentencepieces.Encoder(path).encode(text.encode())
        assert begins[0] == 0 and ends[-1] == len(text.encode()) and (begins[1:] == ends[:-1]).all()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser(rule):
    import sentencepiece

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    own = sentencepieces.Normaliser(library.serialized_model_proto())
    for text in ("Ａｂ ㍿ é  x ", "plain", "", "  ", "é ﬁn 　 Ⅷ½", "¨ a\tb\nc"):
        found, source = own(text.encode())
        assert found.decode() == library.normalize(text)
        assert len(source) == len(found) + 1 and (np.diff(source) >= 0).all()


def test_context_tree(docs, texts):
    learn = lambda k: k is None or zlib.crc32(str(k).encode()) % 7 != 2
    rows = ctw.score(docs, part("doc_id", 7, 2)).collect()
    counts = Counter()
    for k, t in texts:
        if learn(k):
            counts.update(lower(t))
            counts["end"] += 1
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for k, t in texts:
        tokens = [*lower(t), "end"]
        want[k, len(tokens), sum(counts[x] > 0 for x in tokens), round(float(sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in tokens)), 5)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows) == want
    assert all(r.train_tokens == n and r.score < 0 for r in rows)


def test_context_tree_is_a_distribution():
    """The chances of all next bytes sum to one, whatever the context."""
    import pyarrow as pa

    runs, counts = np.unique(ctw.Spelled(pa.array(["abracadabra abra", "cad abra"])).runs, return_counts=True)
    deep = ctw.Trees(runs, counts, ctw.DEPTH, 2)
    keys, times = np.unique(ctw.Spelled(pa.array(["abracadabra abra", "cad abra"]), 2).runs, return_counts=True)
    high = ctw.Trees(keys, times, 2, 0)
    for context in (runs[3] >> np.uint64(8), runs[9] >> np.uint64(8), np.uint64(0x7A7A7A7A7A)):
        every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** ctw.log_chances(every, ctw.DEPTH, deep, high)).sum() - 1) < 1e-9


def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    rows = [(int(k), v.tolist()) for k, v in enumerate(np.concatenate([base, base[:20] + rng.normal(size=(20, 8)) * 0.2, base[:5]]))]
    rows += [(200, None), (201, [0.0] * 8), (202, [float("nan")] + [1.0] * 7), (203, [None] + [1.0] * 7), (204, []), (205, [1.0, 2.0]), (None, base[0].tolist())]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


def test_near_vectors(spark):
    rows, table = vectors(spark)
    usable = {k: np.array(v) for k, v in rows if k is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    linked = {a: {b for b in usable if b != a and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.9 * np.linalg.norm(
        usable[a]) * np.linalg.norm(usable[b])} for a in usable}
    top = {k: k for k, _ in rows}
    for _ in rows:
        for a in linked:
            for b in linked[a]:
                top[a] = top[b] = min(top[a], top[b])
    got = near_vectors.near_duplicates(table).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_links == len(linked.get(r.vec_id, ())) and r.component_id == top[r.vec_id] and r.kept == (r.vec_id is not None and top[r.vec_id] == r.vec_id)


def test_top_k(spark):
    rows, table = vectors(spark)
    whole = {k: np.floor(64 * np.array(v)).astype(int) for k, v in rows if k is not None and v and None not in v and np.isfinite(v).all()}
    want = set()
    for q in whole:
        if q % 5 == 0:
            best = sorted((-int(whole[q] @ x), k) for k, x in whole.items() if k != q and len(x) == len(whole[q]))[:7]
            want |= {(q, n + 1, k, -s) for n, (s, k) in enumerate(best)}
    assert {tuple(r) for r in knn_join.top_k(table, k=7, every=5).collect()} == want


def test_html(spark):
    page = ("<html><head><title>T</title><script>var a='<p>';</script></head><body><nav><a href=#>menu</a></nav><div class='cookie notice'>We use</div>"
            "<article><h1>Head</h1><p>First &amp; long  enough\n text of a story that goes on<p>Second <b>bold</b> part of it, as long as that"
            "<div class=ad>Buy</div><form><input>Search</form></article><div id=comments><p>Nice post, really a long one as well</div><footer>&copy;</footer>")
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, None, "<nav>only</nav>"), (None, "u", page)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    text = "Head\nFirst & long enough text of a story that goes on\nSecond bold part of it, as long as that"
    assert [r.text for r in got] == [text, "", "", "", text] and all(r.n_chars == len(r.text) for r in got)


def test_html_names_and_regions():
    """Names of a page's layout, articles without a content line, headings and ends of unmarked content."""
    long = "A sentence of the story that is long enough to be content of its own. "
    story, lines = f"<h1>Head</h1><p>{long * 3}<p>{long * 2}<p>The end.", f"Head\n{(long * 3).strip()}\n{(long * 2).strip()}\nThe end."
    menu = "<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>"
    for start, end in (("<div class='page has-sidebar'>", "</div>"), ("<main class='no-sidebar'>", "</main>"), ("<div id='header-and-content'>", "</div>"),
                       ("<article class='post category-search'>", "</article>"), ("<div class='search'><article class='search'>", "</article></div>"),
                       ("<div class='header'>", "</div>"), ("<div>", "</div>")):
        assert html_text.main_text(f"<body>{menu}{start}{story}{end}<div class='comments'>Nice</div></body>") == lines, start
    # two halves under names that would both go
    assert html_text.main_text("<div class=share><p>One text</p></div><div class=related><p>One more</p></div>") == "One text\nOne more"
    short = "<article><h2>News</h2><p>Small.</p></article>"
    assert html_text.main_text(f"{menu}{short}<article>{story}</article>") == f"News\nSmall.\n{lines}"
    notice = html_text.main_text(f"<div>{long * 9}</div>{menu}<p>x</p>{short}")
    assert notice == f"{(long * 9).strip()}\nNews\nSmall."
    assert html_text.main_text(f"<main><article>{story}</article><div class=sidebar>Buy</div></main>") == lines
    assert html_text.main_text(f"<article><div class=search>{story}</div><p>x</p></article>") == f"{lines}\nx"
    # an advert longer than the article stays out
    assert html_text.main_text(f"<div class=ad>{long}</div>{short}") == "News\nSmall."


def test_toxicity_and_language(spark, folder):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = part("doc_id", 4, 2)
    scored = toxicity.score(docs, toxicity.train(docs, labels, ~held)).where(held).join(labels, "doc_id").collect()
    bad, good = [r.score for r in scored if r.toxic], [r.score for r in scored if not r.toxic]
    assert np.mean([[a > b for b in good] for a in bad]) > 0.85 and all(0 <= r.score <= 1 for r in scored)
    held = part("doc_id", 5, 0)
    named = language.predict(docs, language.train(docs, ~held)).where(held).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in named]) > 0.95


def test_models_on_odd_texts(docs, texts):
    spark = docs.sparkSession
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(61, None), (None, 1)], "doc_id bigint, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, labels, F.lit(True))).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    rows = language.predict(docs, language.train(docs, F.lit(True))).collect()
    assert Counter(r.lang_pred for r in rows)["und"] == 3 and len(rows) == len(texts)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    found = [
        toxicity.score(empty, toxicity.train(empty, labels, F.lit(True))), near_vectors.near_duplicates(none), substrings.without_repeats(empty),
        packing.pack(empty, tokenizer_path("word_bpe_49k.json")), sentencepieces.encode(empty, tokenizer_path("piece_bpe_32k.model")),
        minhash.near_duplicates(empty), ctw.score(empty, part("doc_id", 7, 2)), language.predict(empty, language.train(empty, F.lit(True))),
        html_text.extract(pages), knn_join.top_k(none),
    ]
    assert [f.count() for f in found] == [0] * len(found)


def test_the_map_of_wanted_texts_loses_none(spark):
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.pmod(F.hash("id"), F.lit(3)).cast("long").alias("twin"))
    wanted = rows.where("doc_id % 7 = 0")
    passed = rows.where(minhash._maybe(wanted, wanted.count()))
    assert passed.where("doc_id % 7 = 0").count() == wanted.count() and passed.count() < 1.2 * wanted.count()
    assert rows.where(minhash._maybe(wanted.limit(0), 0)).count() == 0


def test_prints_lose_no_similar_pair():
    """Members that `_meeting` drops are similar to none of another component; unlike members of one bucket are dropped."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 400)
    sets = [np.unique(np.concatenate([rng.choice(base, k, replace=False), rng.integers(0, 1 << 62, more)]))
            for k, more in zip(rng.integers(300, 400, 60), rng.integers(0, 90, 60), strict=True)]
    sets.append(np.concatenate([np.arange(1, 301) << 8, base[:5]]))  # one class holds more than a byte counts
    sets.append(sets[-1][:280])
    parts, sizes = np.arange(len(sets)) // 3, np.array([len(s) for s in sets])
    prints = np.array([np.minimum(np.bincount(s & (minhash.CLASSES - 1), minlength=minhash.CLASSES), 255) for s in sets], np.uint8)
    want = np.zeros(len(sets), bool)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            want[i] |= parts[i] != parts[j] and 100 * common >= 80 * (len(a) + len(b) - common)
    whole = minhash._meeting(prints, sizes, parts, np.ones(len(sets), bool), 80)
    assert 2 < want.sum() and not (want & ~whole).any() and not whole.all()
    # in parts of a bucket each member is answered for once, as in the whole
    own = np.arange(len(sets)) % 3
    assert (np.logical_or.reduce([minhash._meeting(prints, sizes, parts, own == k, 80) for k in range(3)]) == whole).all()


def test_unlike_members_of_a_bucket_make_no_visits(spark):
    """A bucket of texts that link with none: its rows are read once, and nothing is left to compare block by block."""
    n = 1500
    rows = spark.range(n).select(F.lit(7).cast("long").alias("band"), F.col("id").alias("rep"), F.lit(0).cast("long").alias("twin"),
                                 F.lit(20).cast("long").alias("n_shingles"), F.lit(0).cast("long").alias("first"), F.col("id").alias("component"), F.lit(n).cast("long").alias("size"))
    unlike = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda k: F.xxhash64("id", k))
    full = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("twin"), unlike.alias("shingles"))
    assert minhash._possible(rows, full, 80).count() == 0
    twice = full.withColumn("shingles", F.when(F.col("doc_id") == 9, F.transform(F.sequence(F.lit(1), F.lit(20)), lambda k: F.xxhash64(F.lit(3).cast("long"), k))).otherwise(F.col("shingles")))
    assert sorted(r.rep for r in minhash._possible(rows, twice, 80).collect()) == [3, 9]


def test_packing_looks_a_known_part_up_once():
    """Parts that are known are found by one lookup each; parts that are new are encoded once, also where texts share them."""
    class Counted(dict):
        gets = items = 0

        def get(self, key):
            self.gets += 1
            return dict.get(self, key)

        def __getitem__(self, key):
            self.items += 1
            return dict.__getitem__(self, key)

    path = tokenizer_path("word_bpe_49k.json")
    ids, texts = packing.TextIds(path), pa.array(["It's plain, it's 2 words' length!", "plain 's''t words", "", None, "é <|endoftext|> x"])
    want = [ids.others.ids_of([t or ""])[0] for t in texts.to_pylist()]
    assert ids.encode(texts) == want
    ids.known = Counted(ids.known)
    assert ids.encode(texts) == want and ids.known.items == 0
    assert ids.known.gets == sum(len(packing.PARTS.findall(t)) for t in texts.to_pylist()[:2])
