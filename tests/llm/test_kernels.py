"""Kernels against brute force, without Spark."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waymesh.llm import ann, common, dedup, html, language, media, packing, quality, toxicity

TEXTS = st.lists(st.text(alphabet="aAbß é.\n\t!中", max_size=40), min_size=1, max_size=6)


def view(texts):
    return common.text_bytes(pa.array(texts, pa.string()))


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(2, 5))
def test_shingles_count_like_sets(texts, k):
    data, offsets = view(texts)
    _, first = dedup.shingles(data, offsets, k)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, n in zip(texts, np.diff(first), strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(lower))
        sets = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        assert n == len(sets)


def test_equal_sets_have_equal_hashes():
    data, offsets = view(["A b c d", "a B c d", "x a b c d"])
    values, first = dedup.shingles(data, offsets, 3)
    one, two, three = (set(values[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True))
    assert one == two and one < three


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_grams_count_like_strings(texts):
    data, offsets = view([t.lower() for t in texts])
    u, inv, first = language.grams(data, offsets)
    for i, t in enumerate(texts):
        s = "".join(c if c.isalpha() else " " for c in t.lower())
        p = " " * 3 + s
        want = Counter(p[j : j + 4] for j in range(len(s)) if p[j + 3] != " " or p[j + 2] != " ")
        got = Counter()
        for k in u[inv[first[i] : first[i + 1]]].tolist():
            got["".join(chr(k >> (16 * (3 - j)) & 0xFFFF) for j in range(4))] += 1
        assert got == want


def test_kneser_ney_sums_to_one():
    data, offsets = view(["the cat sat on the mat and the dog ate the hat"])
    u, inv, _ = language.grams(data, offsets)
    n = np.bincount(inv)
    m = language.Model(np.full(len(u), "en", object), u, n)
    letters = [ord(c) for c in " abcdefghijklmnopqrstuvwxyz"]
    seen = {int(k) & 0xFFFF for k in u}
    for k in u[:10]:
        ctx = int(k) >> 16
        total = sum(2.0 ** m.score(np.array([ctx << 16 | c], np.uint64))[0, 0] for c in seen)
        rest = 2.0 ** m.score(np.array([ctx << 16 | 0x4E2D], np.uint64))[0, 0]
        assert total + rest == pytest.approx(1.0, abs=1e-9)
    assert letters


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=2000))
def test_wav_round_trip(text):
    padded = media.padded(text)
    assert len(padded) % 576 == 0 and len(padded) > 0 and padded.startswith(text)
    assert media.from_wav(media.to_wav(padded)) == padded


def test_equal_texts_have_equal_fingerprints_in_any_batch():
    rng = np.random.default_rng(1)
    x = rng.integers(32, 122, 576 * 9, dtype=np.uint8)
    y = rng.integers(32, 122, 576 * 2, dtype=np.uint8)
    alone, _, _ = media.fingerprints(x, np.array([9]))
    both, first, windows = media.fingerprints(np.concatenate([y, x]), np.array([2, 9]))
    assert (both[first[1] : first[2]] == alone).all() and windows.tolist() == [3, 17]
    assert (np.diff(alone >> 24) >= 0).all() and len(alone)


def test_codes_estimate_within_bounds():
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((4000, 64)), rng.standard_normal((20, 64))
    codes, c = ann.encode(x)
    turned = ann.unit(q).astype(np.float32) @ ann.rotation(64).T
    estimate = ann.estimated(codes, c, ann.query_tables(turned))
    error = np.abs(estimate - ann.unit(x) @ ann.unit(q).T)
    bound = ann.EPS * np.sqrt((1 - c * c) / (c * c)) / np.sqrt(63)
    assert (error > bound[:, None]).mean() < 0.005


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=120))
def test_packing_is_gapless_and_near_the_bound(lengths):
    n = np.array(lengths)
    where, offset, bins = packing.pack_shard(n, 50)
    assert bins >= -(-n.sum() // 50)
    for b in range(bins):
        own = np.flatnonzero(where == b)
        order = own[np.argsort(offset[own])]
        assert n[own].sum() <= 50 and (offset[order] == np.concatenate([[0], np.cumsum(n[order])[:-1]])).all()
    assert bins <= len(packing.best_fit(n[n < 50], 50)) + (n >= 50).sum()


def test_local_search_empties_a_bin():
    n = np.array([6, 4, 4, 3, 3])
    bins = packing.improve([[0, 3], [1, 2], [4]], n, 10)
    assert len(bins) == 2


def test_local_search_beats_best_fit():
    for lo, hi in ((300, 1700), (1000, 1500)):
        n = np.random.default_rng(lo).integers(lo, hi, 1500)
        start = packing.best_fit(n, 4096)
        bins = packing.improve(start, n, 4096)
        assert -(-n.sum() // 4096) <= len(bins) < len(start)
        assert sorted(i for b in bins for i in b) == list(range(1500)) and max(n[b].sum() for b in bins) <= 4096


def test_packed_bits_give_the_inner_products_of_codes():
    rng = np.random.default_rng(6)
    for dim in (3, 8, 21):
        x, q = rng.standard_normal((40, dim)), rng.standard_normal((5, dim)).astype(np.float32)
        codes, c = ann.encode(x)
        signs = (np.unpackbits(codes, axis=1, count=dim).astype(float) * 2 - 1) / np.sqrt(dim)
        assert np.allclose(ann.estimated(codes, c, ann.query_tables(q)), signs @ q.T / c[:, None], atol=1e-4)


def test_names_that_hint_count_only_with_links():
    body = "<article><div class='related'><p>related work is part of the text</p></div><header><h1>Title</h1></header></article>"
    assert html.main_text(body) == "related work is part of the text\n\nTitle"
    assert html.main_text("<article><p>kept</p><div class='related'><a href='/a'>one</a> <a href='/b'>two</a></div></article>") == "kept"
    assert html.main_text("<div class='page-header'>Site</div><div class='post'>kept</div>") == "kept"


def test_text_ids_equal_the_tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    vocab = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    whole, mine = tokenizers.Tokenizer.from_file(vocab), packing.TextIds(vocab)
    assert mine.fast is not None
    rng = random.Random(1)
    alphabet = "abcdefghijklmnopqrstuvwxyz éàüßñ中文日本🙂'.,!?0123456789-ABCÉΔΣİ\t\n\0\x1c\x1f\x7f\x85\xa0\u3000 ́ᄀ½²"
    plain = "abcdefghijklmnopqrstuvwxyz '.,!?0123456789-ABC\t\n\v\x1c\x1f\x7f_"
    texts = ["", "It's 12 o'clock,\n\n don't!\tÉté ß 中文 <|endoftext|>x", "ΟΔΟΣ", " ".join(str(i) for i in range(200)), "a" * 3000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    for text in texts:
        assert mine(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_forest_joins_what_is_linked():
    rng = random.Random(5)
    links = {(a, b) for a in range(40) for b in range(40) if rng.random() < 0.03}
    links |= {(b, a) for a, b in links}
    edges = list(dedup.forest(40, lambda i, rest: np.array([(i, j) in links for j in rest])))
    label = list(range(40))
    for _ in range(40):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    mine = list(range(40))
    for a, root in edges:
        mine[a] = root
    assert mine == label and len(edges) < 40


PAGE = (
    '<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a href="/a>b">menu</a></nav>'
    '<div class="ad">buy</div><article><h1>Head &amp; line</h1><p>One\n  two<br>three <b>bold</b>er.<p>Four &lt;5&gt;</p><aside>side</aside><form>f</form>'
    '<div class="reader-comments">me too</div></article><footer>&copy;</footer></body></html>'
)


def test_main_text():
    assert html.main_text(PAGE) == "Head & line\n\nOne two three bolder.\n\nFour <5>"
    assert html.main_text(None) == html.main_text("") == html.main_text("<nav>x</nav>") == ""
    assert html.main_text("<article><p>a &am") == "a &am" and html.main_text("<article><p>a</p><p") == "a"
    assert html.main_text("plain  text") == "plain text"
    assert html.main_text("<div>" * 5000 + "deep") == "deep"


def test_sentences_find_words_and_rows():
    texts = ["Ab cd. Ef!", "", "gh", "..."]
    data, offsets = view(texts)
    start, end, of, feature, first = toxicity.sentences(common.LOWER[data], offsets)
    assert of.tolist() == [0, 2, 2, 3, 3] and len(first) == 4
    assert np.diff(first).tolist() == [2, 1, 1] and len(feature) == 4
    assert [bytes(data[a:b]) for a, b in zip(start, end, strict=True)] == [b"Ab cd.", b" Ef!", b"gh"]


def test_multiple_instances_locate_the_offence():
    good, bad = [[1, 2], [3, 4], [2, 5]], [[1, 2], [7, 3], [4, 5]]
    docs = [good] * 20 + [bad] * 20
    feature = np.array([f for d in docs for s in d for f in s])
    first = np.arange(0, len(feature) + 1, 2)
    doc = np.repeat(np.arange(40), 3)
    w, bias = toxicity.fit(feature, first, doc, np.array([0] * 20 + [1] * 20))
    p = toxicity.sigmoid(toxicity._sums(w, feature, first) + bias)
    assert p[61] > 0.5 > max(p[60], p[62]) and p[:60].max() < 0.2


def test_ordinal_thresholds_are_ordered_and_grades_rise():
    rng = np.random.default_rng(2)
    grade = rng.integers(0, 3, 300)
    u = np.where(rng.random((300, 20)) < (grade[:, None] + 0.5) / 3, 1, 2).ravel()
    w, th = quality.fit(u, np.full(6000, 0.05), np.arange(0, 6001, 20), grade, 3)
    assert (np.diff(th) > 0).all() and w[1] > w[2]


def test_repeats():
    data, offsets = view(["a a a b", "", "b b", "c"])
    assert quality.repeats(data, offsets).tolist() == [2, 0, 1, 0]


def test_digests_are_of_what_is_read_back():
    p = media.padded(b"abc")
    assert len(p) == 576 and zlib.crc32(p[-32:]) == zlib.crc32(b"\xff" * 32) and len(hashlib.sha256(p).hexdigest()) == 64
