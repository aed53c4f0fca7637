"""Each text operator against a plain version of itself on a small table with nulls, empty and very
long texts, ties, repeated rows and columns with clashing names, and on an empty table."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from public_tokenizers import path
from tokenizers import Tokenizer, models

from gaugeline.llm import (
    bpe, fingerprints, packing, page_text, personal_data, quality_classifier, quality_rules, simhash, token_counts, token_files,
)

BYTE, WORD = path("byte_bpe_50k.json"), path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, code string, _part int, start string, rank string, x string, root string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _sentences(seed, n):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice(("an", "er", "the", "tion", "ble", "é", "ß", "on", "st")) for _ in range(draw.randint(1, 4)))
    return " ".join(word() + draw.choice(("", "", "", ",", ".")) for _ in range(n)) + "."


def _texts():
    base = [_sentences(i, 60 + 9 * i) for i in range(12)]
    near = base[3].replace(" ", "  ", 1) + " end"
    noisy = " ".join(w + "***" for w in base[4].split())
    loud = "\n".join((" ".join(w.upper() + "!!" for w in base[5].split()), "One calm line stays here, with words enough."))
    twice = "\n".join([base[6], base[6], "Licensed under the MIT License.", base[7], base[8]])
    personal = (
        "Write to jo.doe+1@mail7.example.com, +1 (974) 555-3436 or 10.0.0.255; not 10.0.0.256 x@y @ a@b. "
        "Card 4111 1111 1111 1111 and 4111 1111 1111 1112 or 12-34. <|endoftext|> it's  \t odd\r\n\n é́ ΑΣ ǅ 日本語 \x00 ₝"
    )
    return [None, "", "   \n\t ", "a", "a b", *base, base[2], base[2], near, noisy, loud, twice, personal, _sentences(99, 20_000), "x" * 3_000, ("same line\n" * 300)]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "en", "s", len(t or ""), "c", 1, "s", "r", "x", "z") for i, t in enumerate(_texts())]
    return [*out, out[7], out[7], (None, "no key here", *out[0][2:]), (None, None, *out[0][2:])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _pairs(df, columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# -- 1: token counts ----------------------------------------------------------------------------


def test_piece_counter_is_greedy_word_piece():
    draw = random.Random(2)
    first, rest = [b"a", b"abcd", b"ab"], [b"b", b"c", b"bc", b"cde"]
    ours = token_counts.PieceCounter(first, rest)
    vocabulary = [p.decode() for p in first] + ["##" + p.decode() for p in rest] + ["[UNK]"]
    theirs = models.WordPiece({p: i for i, p in enumerate(vocabulary)}, unk_token="[UNK]")
    words = ["".join(draw.choice("abcde") for _ in range(draw.randint(1, 9))) for _ in range(500)]
    want = [len(theirs.tokenize(w)) for w in words]
    assert ours.counts(pa.array(words)).tolist() == want == [ours.one(w.encode()) for w in words]


def test_token_counts(docs, rows, nothing):
    symbols = {b: c for c, b in token_counts.byte_symbols().items()}
    spell = lambda p: "".join(symbols[b] for b in p)
    first, rest = token_counts.pieces_of(BYTE)
    vocabulary = {v: i for i, v in enumerate(dict.fromkeys([*map(spell, sorted(first)), *("##" + spell(p) for p in sorted(rest)), "[UNK]"]))}
    plain = models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=1_000_000)
    count = lambda t: [len(plain.tokenize(spell(w.encode()))) for w in WORDS.findall(t or "")]
    want = Counter((r[0], len(count(r[1])), sum(count(r[1]))) for r in rows)
    assert _pairs(token_counts.token_counts(docs, BYTE), ("doc_id", "n_words", "n_tokens")) == want
    assert token_counts.token_counts(nothing, BYTE).count() == 0


# -- 2: quality rules ---------------------------------------------------------------------------


def _judged(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dups, len(covered), failed


def test_quality_rules(docs, rows, nothing):
    found = quality_rules.quality_rules(docs)
    want = Counter((r[0], *_judged(r[1])) for r in rows)
    assert _pairs(found, ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    texts = _texts()
    noisy, loud, twice, long = (next(i for i, t in enumerate(texts) if t and mark in t) for mark in ("***", "!!", "MIT", _sentences(99, 20_000)))
    assert kept[8] and kept[long] and not kept[noisy] and not kept[loud]
    clean = {r["doc_id"]: r for r in quality_rules.cleaned(docs).collect()}
    assert set(clean) == {i for i, k in kept.items() if k} and list(clean[8].asDict()) == docs.columns
    assert twice in clean and clean[twice]["text"] == "\n".join([_sentences(6, 114), _sentences(7, 123), _sentences(8, 132)])
    assert clean[8]["text"] == texts[8]
    assert quality_rules.quality_rules(nothing).count() == 0 and quality_rules.cleaned(nothing).count() == 0


# -- 3: token files -----------------------------------------------------------------------------


def test_token_files(docs, rows, nothing, tmp_path):
    library = Tokenizer.from_file(BYTE)
    ids = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
    manifest = token_files.write_token_files(docs, BYTE, 2, folder=str(tmp_path / "out"))
    found = sorted(token_files.read_token_files(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    want = Counter((r[0], len(ids(r[1])), zlib.crc32(ids(r[1]).tobytes())) for r in rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want
    assert [r["start"] for r in found] == [0, *np.cumsum([r["n_tokens"] for r in found])[:-1]]
    by_id = {r[0]: r[1] for r in rows if r[0] is not None}
    for row in manifest.collect():
        file = token_files.TokenFile(row["path"])
        for i, key in enumerate(file.keys.to_pylist()):
            if key is not None:
                assert file.document(i).tolist() == ids(by_id[key]).tolist()
    assert token_files.read_token_files(token_files.write_token_files(nothing, BYTE, 2)).count() == 0


def test_token_file_finds_damage(tmp_path):
    place = tmp_path / "a.zst"
    with open(place, "wb") as stream:
        writer = token_files.TokenFileWriter(stream, pa.int64())
        writer.add(pa.array([1, 2]), np.arange(150_000), np.array([0, 10, 150_000]))
        assert writer.close() == (2, 150_000)
    import zstandard

    plain = zstandard.ZstdDecompressor().stream_reader(place.read_bytes(), read_across_frames=True).read(600_000)
    assert np.frombuffer(plain, "<u4").tolist() == list(range(150_000))
    assert token_files.TokenFile(str(place)).document(1)[-1] == 149_999
    raw = bytearray(place.read_bytes())
    raw[200_000] ^= 1
    place.write_bytes(raw)
    with pytest.raises(Exception):
        list(token_files.TokenFile(str(place)).checksums())


# -- 4: quality classifier ----------------------------------------------------------------------


def test_isotonic_is_the_nearest_rising_sequence():
    draw = np.random.default_rng(1)
    for _ in range(50):
        v, w = draw.normal(size=7), draw.uniform(0.5, 2, 7)
        got = quality_classifier.isotonic(v, w)
        # The min-max formula of isotonic regression.
        mean = lambda a, b: (v[a:b] * w[a:b]).sum() / w[a:b].sum()  # noqa: B023, E731
        want = [max(min(mean(a, b + 1) for b in range(i, 7)) for a in range(i + 1)) for i in range(7)]
        assert np.allclose(got, want)


def test_classifier_learns_and_holds_out(spark):
    good = [(i, _sentences(i, 80), 1) for i in range(0, 400, 2)]
    bad = [(i, " ".join(w + "$$$" for w in _sentences(i, 80).split()), 0) for i in range(1, 400, 2)]
    both = good + bad
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in both], "doc_id bigint, text string, y string").repartition(5)
    labels = spark.createDataFrame([(i, q) for i, _, q in both] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    found = {r["doc_id"]: r for r in quality_classifier.scored(docs, labels).collect()}
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in both)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found.values())
    assert np.mean([found[i]["predicted"] == q for i, _, q in both if found[i]["held_out"]]) > 0.97
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - quality else quality end as quality")
    again = {r["doc_id"]: r["score"] for r in quality_classifier.scored(docs, flipped).collect()}
    assert all(abs(again[i] - found[i]["score"]) < 1e-9 for i in again)  # held-out labels change nothing
    assert {r["doc_id"] for r in quality_classifier.kept_documents(docs, labels).collect()} == {i for i in found if found[i]["predicted"]}


def test_classifier_cases(spark, docs, rows, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    found = quality_classifier.scored(docs, none)
    assert _pairs(found, ("doc_id",)) == Counter((r[0],) for r in rows) and {r["score"] for r in found.collect()} == {0.5}
    assert quality_classifier.scored(nothing, none).count() == 0


# -- 5: personal data ---------------------------------------------------------------------------

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def _plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    good = (
        lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")),
        lambda s: 13 <= len(digits(s)) <= 19 and personal_data.luhn(digits(s)), lambda s: 9 <= len(digits(s)) <= 15,
    )
    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if good[k](m[0])]


def test_patterns_in_linear_time_find_the_same():
    draw = random.Random(4)
    for _ in range(3000):
        text = "".join(draw.choice("a1.@ -+()24%_") for _ in range(draw.randint(0, 40)))
        assert personal_data.base_spans(text)[0] == _plain_spans(text), text
    for text in ("a" * 300_000, "1" * 200_000, "1." * 100_000, "+1 " * 50_000, "a@" * 100_000):
        personal_data.base_spans(text)


def test_tagger_gradients():
    from gaugeline.llm import tagger

    draw = np.random.default_rng(0)
    p = tagger.initial(tagger.Shape(6, 3, 4, 5), 1)
    symbols, tags = draw.integers(0, 6, (3, 7)), draw.integers(0, 3, (3, 7))
    _, grads = tagger.loss_and_gradients(p, symbols, tags)
    for name in p:
        i = tuple(draw.integers(0, n) for n in p[name].shape)
        for step in (1e-5,):
            up, down = dict(p), dict(p)
            up[name], down[name] = p[name].copy(), p[name].copy()
            up[name][i] += step
            down[name][i] -= step
            want = (tagger.loss_and_gradients(up, symbols, tags)[0] - tagger.loss_and_gradients(down, symbols, tags)[0]) / (2 * step)
            assert abs(want - grads[name][i]) < 1e-6, name


def test_viterbi_is_the_best_sequence():
    from itertools import product

    from gaugeline.llm import tagger

    p = tagger.initial(tagger.Shape(5, 3, 4, 4), 2)
    p["move"] = np.random.default_rng(1).normal(size=(3, 3))
    symbols = np.random.default_rng(2).integers(0, 5, (4, 5))
    scores = tagger.emissions(p, symbols)
    value = lambda s, t: s[range(5), t].sum() + sum(p["move"][a, b] for a, b in zip(t, t[1:])) + p["first"][t[0]] + p["last"][t[-1]]
    best = [max(product(range(3), repeat=5), key=lambda t, s=s: value(s, t)) for s in scores]
    assert tagger.viterbi(p, scores).tolist() == [list(b) for b in best]


def test_personal_data(spark, docs, rows, nothing):
    found = personal_data.personal_data(docs, personal_data.Settings(steps=60))
    want = Counter()
    for r in rows:
        spans = _plain_spans(r[1] or "")
        kinds = [sum(k == i for k, _, _ in spans) for i in range(4)]
        want[(r[0], *kinds, hashlib.sha256(personal_data.listed(spans).encode()).hexdigest())] += 1
    assert _pairs(found, ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")) == want
    for r in found.collect():
        text = next((x[1] or "" for x in rows if x[0] == r["doc_id"]), "")
        if r["doc_id"] is not None:
            assert set(personal_data.listed(_plain_spans(text)).split(",")) <= set(r["spans"].split(","))
    clean = {r["doc_id"]: r["text"] for r in personal_data.masked(docs, personal_data.Settings(steps=60)).collect()}
    assert clean[0] is None and clean[5] == rows[5][1]
    marked = next(t for t in clean.values() if t and "Write to" in t)
    assert "[EMAIL]" in marked and "[PHONE]" in marked and "[IP]" in marked and "[CARD]" in marked and "4111 1111 1111 1111" not in marked
    assert personal_data.personal_data(nothing).count() == 0


def test_tagger_adds_spans_that_patterns_miss(spark):
    draw = random.Random(5)
    digit = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    texts = []
    for i in range(400):
        parts = [f"u{i}.{digit(2)}@mail{i % 9}.example.com", f"{digit(2)}.{digit(2)}.{digit(2)}.{digit(2)}", f"+1 ({digit(3)}) 555-{digit(4)}"]
        texts.append(f"{_sentences(i, 9)} {parts[i % 3]} {_sentences(i + 1, 9)}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = personal_data.fit(docs)
    hidden = "and the ertion jo.doe at mail7 dot example dot com was onthe. The number (974) 555-3436 is here."
    base, more = personal_data.spans_of(pa.array([hidden, _sentences(1, 200)]), model, personal_data.Settings())[0]
    assert not base and {"email", "phone"} & {personal_data.KINDS[k] for k, _, _ in more}
    assert personal_data.spans_of(pa.array([_sentences(1, 200)]), model, personal_data.Settings()) == [([], [])]


# -- 6: near-duplicates -------------------------------------------------------------------------


def _plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_components(codes):
    parent = list(range(len(codes)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array(codes, np.uint64)
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3) + i + 1:
            a, b = top(i), top(int(j))
            parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(codes))]


def test_near_duplicates(docs, rows, nothing):
    found = simhash.grouped(docs)
    codes = [_plain_fingerprint(r[1]) for r in rows]
    tops = _plain_components(codes)
    least = {t: min((r[0] for r, u in zip(rows, tops) if u == t and r[0] is not None), default=None) for t in tops}
    want = Counter((r[0], f"{c:016x}", least[t]) for r, c, t in zip(rows, codes, tops))
    assert _pairs(found, ("doc_id", "fingerprint", "component_id")) == want
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(set(least.values()))
    assert simhash.grouped(nothing).count() == 0 and simhash.representatives(nothing).count() == 0


def test_links_of_large_groups_are_whole(spark):
    """Clusters far larger than a group, with chains across them."""
    draw = random.Random(6)
    codes = set()
    for _ in range(3):
        code = draw.getrandbits(64)
        for _ in range(900):
            codes.add(code ^ sum({1 << draw.randrange(64) for _ in range(draw.randint(0, 4))}))
    for _ in range(300):
        codes.add(draw.getrandbits(64))
    code = draw.getrandbits(64)
    for bit in range(0, 60, 3):
        code ^= 7 << bit
        codes.add(code)
    codes = sorted(codes)
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    setting = simhash.NearDup(group=272)
    table = spark.createDataFrame(signed, "code bigint").repartition(4)
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(table, setting)).collect()}
    tops = _plain_components(codes)
    ours = [roots.get(s[0], s[0]) for s in signed]
    assert len(set(zip(ours, tops))) == len(set(ours)) == len(set(tops))


def test_thresholds_use_the_general_pigeonhole():
    counts = [np.full(1 << 16, 1), np.full(1 << 16, 1), np.full(1 << 16, 1), np.zeros(1 << 16, int)]
    counts[3][5] = 1 << 16  # a partition that tells nothing is not used
    chosen = simhash.allotted(counts, 3)
    assert sum(chosen) == 0 and chosen[3] == -1


# -- 7: byte-pair encoding ----------------------------------------------------------------------


def test_bpe_is_the_librarys():
    draw = random.Random(8)
    library, ours = Tokenizer.from_file(WORD), bpe.coder_of(WORD)
    texts = [t or "" for t in _texts() if len(t or "") < 50_000]
    texts += ["".join(draw.choice("aeinrst") for _ in range(draw.randint(1, 14))) for _ in range(1500)]
    texts += ["".join(draw.choice("ab") for _ in range(draw.randint(1, 20))) for _ in range(300)]
    texts += ["".join(chr(draw.randint(33, 0x2FFF)) for _ in range(9)) for _ in range(200)]
    texts += ["aaaaaaa aaaaaa", "don't-'ve 'll'd '", "<|startoftext|>x<|endoftext|> <|x", "👩‍👩‍👧 ✨.", "İ Σ ΑΣ"]
    ids, at = ours.encode(pa.array(texts))
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[at[i] : at[i + 1]].tolist() == want, text
        assert ours.decode(want).decode() == library.decode(want, skip_special_tokens=False)


def test_bpe_speculation_is_used_and_verified():
    coder = bpe.coder_of(WORD)
    words = [w.lower().encode() for w in "the mississippi banana ertion thereon onthanen".split()]
    symbols = np.concatenate([np.frombuffer(w, np.uint8).astype(np.int64) for w in words])
    at = np.cumsum([0, *map(len, words)])
    symbols[at[1:] - 1] += bpe.LAST
    exact, exact_at = coder.merged(coder.base[symbols], at)
    got, got_at = coder.words(symbols, at)
    assert got.tolist() == exact.tolist() and got_at.tolist() == exact_at.tolist()


def test_bpe_digests(docs, rows, nothing):
    library = Tokenizer.from_file(WORD)
    want = Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert _pairs(bpe.digests(docs, WORD), ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == want
    assert _pairs(bpe.encoded(docs, WORD).selectExpr("doc_id", "size(ids) as n"), ("doc_id", "n")) == Counter((r[0], k[1]) for r, k in zip(rows, [(r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]))
    assert bpe.digests(nothing, WORD).count() == 0


# -- 8: packing ---------------------------------------------------------------------------------


def test_nnls_meets_its_optimality_conditions():
    draw = np.random.default_rng(3)
    for _ in range(20):
        a, b = draw.uniform(size=(8, 15)), draw.normal(size=8)
        x = packing.nnls(a, b)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and (gradient < 1e-6).all() and np.abs(gradient[x > 1e-9]).max(initial=0) < 1e-6


def test_plan_uses_every_piece_once():
    draw = random.Random(9)
    for bins in (5, 16, 64):
        histogram = {b: draw.randint(0, 500) for b in range(1, bins + 1)}
        plan = packing.plan_sequences(histogram, bins)
        used = Counter()
        for combination, n in plan:
            assert n > 0 and sum(combination) <= bins
            for b in combination:
                used[b] += n
        assert used == +Counter(histogram)
        room = bins * sum(n for _, n in plan)
        assert sum(b * n for b, n in histogram.items()) > 0.9 * room


def test_packing(docs, rows, nothing):
    library = Tokenizer.from_file(WORD)
    ids = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
    found = packing.packed(docs, WORD).collect()
    want = Counter()
    for r in rows:
        own = ids(r[1])
        for at in range(0, len(own), 2048):
            part = own[at : at + 2048]
            want[r[0], at, len(part), zlib.crc32(part.tobytes()), len(own)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.packed(nothing, WORD).count() == 0


# -- 9: page text -------------------------------------------------------------------------------


def _lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@pytest.mark.parametrize("cells", [1, page_text.CELLS])
def test_alignment_is_a_longest_common_subsequence(cells):
    draw = random.Random(10)
    for _ in range(800):
        a = [draw.randint(0, 4) for _ in range(draw.randint(0, 14))]
        b = [draw.randint(0, 4) for _ in range(draw.randint(0, 14))]
        places = page_text.shared(a, b, cells)
        rest = iter(b)
        assert len(places) == _lcs(a, b) and all(any(y == a[i] for y in rest) for i in places)


def test_page_lines():
    page = (
        "<!DOCTYPE html><head><title>T</title><script>var t='</p>';</script></head><body><nav><a>Home</a></nav>"
        "<div class='top ad'>Buy</div><article><h1>A &amp; B</h1><p><b>x<br><p>y  <i>z</i>w&nbsp;q</p><aside>no</aside></article>"
        "<footer>&copy; f</footer><p>tail<foot"
    )
    lines, zones = page_text.lines_of(page)
    assert [x for x, z in zip(lines, zones) if z == page_text.MAIN] == ["A & B", "x", "y zw q"]
    assert page_text.main_text(page, None) == "A & B x y zw q" and "tail" in lines and "Home" in lines
    plain = "<p>Menu of all<p>One text.<p>Imprint &am<script>1"
    assert page_text.main_text(plain, None) == "Menu of all One text. Imprint &am"


def test_page_texts(spark):
    shell = "<p>Welcome to the site<p>{0}<p>{1}<p>All rights"
    rows = [(i, f"http://a.example/en/{i}", shell.format(f"First of {i}", f"Second of {i}")) for i in range(20)]
    rows += [(100, "http://b.example/x", shell.format("alone", "here")), (101, None, shell.format("no", "host")), (102, "http://c.example/", None)]
    rows += [(103, "http://d.example/1", shell.format("copy", "copied")), (104, "http://d.example/2", shell.format("copy", "copied"))]
    rows += [(None, "http://e.example/1", ""), rows[3], (105, "http://f.example/1", "<article><p>Quoted</article>"), (106, "http://f.example/2", "<article><p>Quoted<p>more</article>")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, host string, gone int").repartition(4)
    found = page_text.page_texts(pages).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert Counter(r["page_id"] for r in found) == Counter(r[0] for r in rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    assert all(texts[i] == f"First of {i} Second of {i}" for i in range(20) if i != 3)
    assert texts[100] == "Welcome to the site alone here All rights" and "no host" in texts[101] and texts[102] == ""
    assert texts[103] == texts[104] == "Welcome to the site copy copied All rights"  # copies tell nothing
    assert texts[105] == "Quoted" and texts[106] == "Quoted more"
    assert page_text.page_texts(pages.limit(0)).count() == 0


# -- 10: fingerprints ---------------------------------------------------------------------------


def test_fingerprints(docs, rows, nothing):
    found = fingerprints.document_fingerprints(docs, ranges=9)
    ordered = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -1))
    assert found.count() == len(rows)
    by_id = {r["doc_id"]: r for r in found.collect() if r["doc_id"] is not None}
    texts = [(r[0], r[1] or "") for r in ordered]
    for k, (key, text) in enumerate(texts):
        if key is None or key in (7, 0):  # repeated, and next to rows without a key
            continue
        after = texts[(k + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = by_id[key]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        assert (row["fingerprint"] == row["edited_fingerprint"]) == (row["near_edited"] == 1.0)
    assert by_id[1]["fingerprint"] == by_id[0]["fingerprint"] and by_id[17]["fingerprint"] == by_id[18]["fingerprint"]
    assert by_id[16]["near_edited"] > by_id[16]["near_next"]
    assert len({r["fingerprint"] for r in by_id.values()}) == len({re.sub(r"\n+", "\n", t).strip("\n") for k, t in texts if k is not None})
    assert fingerprints.document_fingerprints(nothing).count() == 0
    one = fingerprints.document_fingerprints(docs.filter("doc_id = 8")).first()
    assert one["near_next"] == 1.0


def test_fingerprints_add_and_take_away(spark):
    from pyspark.sql import functions as F

    a, b = "one two.\nthree four five.", "six.\nseven eight. nine"
    frame = spark.createDataFrame([(a, b, b + "\n" + a)], "a string, b string, ba string")
    prints = frame.select(*[fingerprints.fingerprint(F.col(c)).alias(c) for c in frame.columns])
    row = prints.select(
        (fingerprints.combined(F.col("a"), F.col("b")) == F.col("ba")).alias("sum"),
        (fingerprints.combined(F.col("ba"), F.col("b"), -1) == F.col("a")).alias("rest"),
        (F.length("a") == fingerprints.HEX).alias("length"),
    ).first()
    assert row["sum"] and row["rest"] and row["length"]


def test_navigation_lines():
    rules = quality_rules.Rules()
    text = "This is a line of prose, which ends as prose does.\nIt goes on here."
    menus = [
        "Home About Products Contact Login", "Home / About us / Contact", "Home · Neues · Über uns · Kontakt", "Start » Shop » Shoes",
        "News > World > Europe", "Home\nAbout us\n\nProducts\nContact",
    ]
    plain = ["Anna und Berta gehen heim", "He gave and / or took", "Dr. Anna Berta Carl", "One\nTwo words\nThree", "Yes.\nNo.\nOh.\nWell.", "a\nb\nc\nd"]
    for menu in menus:
        page = f"{text}\n{menu}\n{text}x"
        assert quality_rules.judge(pa.array([page]), rules)["n_lost_words"].tolist() == [len(menu.split()) + 11], menu  # the first line of prose is there twice
    for line in plain:
        assert quality_rules.judge(pa.array([line]), rules)["n_lost_words"].tolist() == [0], line


def test_navigation_rules_as_sql(spark):
    import duckdb

    draw = random.Random(6)
    words = ["Home", "About", "us", "/", "·", "»", ">", "|", "É", "news", "End.", "Über", "A", "//", "-"]
    texts = ["\n".join(" ".join(draw.choices(words, k=draw.randint(0, 6))) + draw.choice(("", " ", "\t")) for _ in range(draw.randint(1, 12))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)]
    duck = duckdb.connect()
    documents = pa.table({"doc_id": [r[0] for r in rows], "text": texts})
    duck.register("documents", documents)
    theirs = {r[0]: r[-1] for r in duck.execute(f"select doc_id, n_lost_words from ({quality_rules.rules_sql()})").fetchall()}
    ours = quality_rules.judge(pa.array(texts), quality_rules.Rules())["n_lost_words"].tolist()
    assert ours == [theirs[i] for i in range(len(texts))]
