"""Operators that SQL can't express against versions by plain loops, on small tables."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import regex

from siltstone.llm import decontamination, jaccard, licences, quality, queries, substrings, toxicity
from siltstone.llm.wordhash import IS_MARK, Words

DATA = "/root/testdata/sf0.001"


def documents(spark, sf_dir=DATA):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def thue_morse(n, a, b):
    return "".join(b if k.bit_count() % 2 else a for k in range(n))


# words that any polynomial modulo 2**64 takes for one


def test_hashes_tell_apart_what_polynomials_do_not(spark):
    one, other = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    shared = " ".join(f"w{k}" for k in range(19))
    rows = [(1, f"{shared} {one}"), (2, f"{shared} {other}"), (3, one), (4, other), (5, f"{shared} {one}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substrings.substring_dedup(df, digest=True).collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 20}
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_join(df.where("doc_id > 2")).collect()} == {3: 3, 4: 4, 5: 5}


def test_empty_rows_of_an_id_link_nothing(spark, monkeypatch):
    say = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    common = " ".join(f"c{j}" for j in range(20))
    rows = [(k, t) for k in (1, 2, 3) for t in ("", None, f"{common} {say(k)}")] + [(4, f"{common} {say(1)}"), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_join(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 1}
    assert not list(jaccard.similar([np.zeros(0, np.uint64)] * 3))


@pytest.mark.parametrize("lower", [False, True])
def test_word_and_window_hashes(lower):
    r = random.Random(2)
    parts = ["a", "B", "ab", "ü" * 9, "x" * 64, "x" * 65, "y" * 300, "abcdefgh", "abcdefghi", " ", ""]
    texts = [" ".join(r.choice(parts) + r.choice(parts) for _ in range(r.randrange(30))) for _ in range(300)] + [None, ""]
    w = Words(pa.array(texts), lower=lower, lanes=2)
    for lane in range(2):
        told, back = {}, {}
        for size in (1, 3, 5, 20):
            starts, _ = w.windows(size)
            for s, h in zip(starts.tolist(), w.window_hashes(starts, size, lane).tolist(), strict=True):
                key = tuple(w.text(k).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) if lower else w.text(k) for k in range(s, s + size))
                assert told.setdefault(key, h) == h and back.setdefault(h, key) == key
    assert not set(w.lanes[0].tolist()) & set(w.lanes[1].tolist())


# 3


def js(p, q):
    if sum(p) <= 0 or sum(q) <= 0:
        return 0.0
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    part = lambda x, m: x * math.log2(x / m) if x > 0 else 0.0
    return math.sqrt(max(0.0, sum((part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2 for x, y in zip(p, q, strict=True))))


def test_quality_verdicts(spark):
    limits = quality.Limits(min_documents=5)
    rows = documents(spark)
    rows += [(10_000 + k, r[1], None if k % 2 else r[2], r[3]) for k, r in enumerate(rows[:40])] + [(20_000, None, "en", "s"), (20_001, "", "xx", "s")]
    word = regex.compile(r"[^\x20\x09-\x0D]+")
    features = {}
    for k, text, lang, _ in rows:
        text, lang = text or "", lang or ""
        words = word.findall(text)
        windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        upper, digit, wide = (len(regex.findall(p, text)) for p in ("[A-Z]", "[0-9]", r"[^\x00-\x7F]"))
        mark, space = len(regex.findall(r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]", text)), len(regex.findall(r"[\x20\x09-\x0D]", text))
        chars = [upper, digit, mark, wide, space, max(0, len(text) - upper - digit - mark - wide - space)]
        common = [words.count(w) for w in quality.COMMON.get(lang, ())]
        common = common + [0] * (12 - len(common))
        features[k] = lang, len(text), len(words), len(words) < 20 or 100 * len(repeated) > 30 * len(words), chars, [*common, len(words) - sum(common)]
    total = collections.defaultdict(lambda: [0, [0.0] * 6, [0.0] * 13])
    for lang, _, n, failed, chars, common in features.values():
        if not failed and n >= limits.min_words:
            t = total[lang]
            t[0] += 1
            t[1], t[2] = [a + b for a, b in zip(t[1], chars, strict=True)], [a + b for a, b in zip(t[2], common, strict=True)]
    want = {}
    for k, (lang, length, n, failed, chars, common) in features.items():
        far = near = 0.0
        if total[lang][0] >= limits.min_documents:
            far = js(chars, total[lang][1]) if length >= limits.min_chars else 0.0
            near = js(common, total[lang][2]) if lang in quality.COMMON and n >= limits.min_words else 0.0
        want[k] = not failed and far <= limits.chars and near <= limits.common, far, near
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality_rules(df, limits).collect()}
    assert set(got) == set(want) and {True, False} == {k for k, _, _ in want.values()}
    for k, (kept, far, near) in want.items():
        assert got[k].kept == kept and abs(got[k].char_distance - far) < 1e-9 and abs(got[k].common_distance - near) < 1e-9


# 4


def py_terms(text):
    return regex.findall(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*", regex.sub(licences.SPDX, "SPDX-", text).lower())


def by_hand(files):
    """Licence and score of each text (id, name, text), by plain TF-IDF over the same headers, files, lines and windows."""
    speaks, over = regex.compile(licences.SPEAKS), regex.compile(licences.SPEAKS_OVER_LINES)
    is_file = regex.compile(licences.LICENCE_FILE)
    samples = [(name, py_terms(body)) for name, body in [*licences.TEMPLATES, *licences.FULL_TEXTS]]
    notices = samples[: len(licences.TEMPLATES)]

    def speaking_places(words):
        joined = " ".join(words)
        return sorted({joined.count(" ", 0, m.start()) for m in speaks.finditer(joined)})

    spans = {(p[0], len(w) - 1 - p[0]) for _, w in notices if (p := speaking_places(w))} | {(n, n) for n in licences.RADII}
    units = {}
    for k, name, text in files:
        if text and over.search(text):
            words = py_terms(text)
            headers = [" ".join(words[:n]) for n in licences.HEADERS]
            own = {x for x in text.split("\n") if speaks.search(x)} | ({" ".join(words)} if is_file.search(name) else set())
            units[k] = own, {x for x in headers if speaks.search(x)} - own, words
    known = {t for _, w in notices for t in w}
    lines = [py_terms(x) for own, _, _ in units.values() for x in own]
    df = collections.Counter(t for w in lines for t in set(w))
    idf = {t: math.log((1 + len(lines)) / (1 + df[t])) + 1 for t in known}

    def vector(words):
        v = {t: n * idf.get(t, 1.0) for t, n in collections.Counter(words).items()}
        return v, math.sqrt(sum(x * x for x in v.values()))

    templates = [(name, *vector(w)) for name, w in samples]

    def fits(words, only_short, least):
        v, norm = vector(words)
        for name, t, t_norm in templates[: len(notices)] if only_short else templates:
            if norm:
                score = round(sum(v.get(x, 0.0) * y for x, y in t.items()) / norm / t_norm, 6)
                if score >= least:
                    yield -score, name

    out = {}
    for k, (own, headers, words) in units.items():
        found = [f for x in own | headers for f in fits(py_terms(x), False, licences.MIN_COSINE)]
        for i in speaking_places(words):
            for before, after in spans:
                window = words[max(0, i - before) : i + after + 1]
                found += fits(window, True, licences.MIN_SHORT_COSINE if len(window) < licences.SHORT else licences.MIN_COSINE)
        if found:
            out[k] = min(found)[::-1]
    return {k: (name, -s) for k, (name, s) in out.items()}


def test_licences_by_hand(spark):
    r = random.Random(5)
    other = lambda n: " ".join(f"w{r.randrange(400)}" for _ in range(n))
    files = [(d[0], "t.txt" if d[0] % 10 else "LICENSE", d[1]) for d in documents(spark)]
    full = [body for _, body in licences.FULL_TEXTS]
    for k, body in enumerate(full):
        wrapped = "\n * ".join(" ".join(body.split(" ")[i : i + 11]) for i in range(0, len(body.split(" ")), 11))
        files += [(5000 + k, "LICENSE", body), (5100 + k, "a.c", f"/*\n * {wrapped}\n */\n{other(400)}"), (5200 + k, "COPYING", f"Copyright 2020 {other(6)}\n{wrapped}")]
    files += [(6000, "LICENSE", other(50)), (6001, "LICENSE", "copyright " + other(200)), (6002, "x", f"{other(70)} license {other(200)}")]
    df = spark.createDataFrame(files, "doc_id long, name string, text string")
    want = by_hand(files)
    got = {x.doc_id: (x.licence, x.score) for x in licences.licence_scan(df, df["name"]).where("origin = 'own'").collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want)
    assert all(got[5000 + 100 * j + k][0] == name for k, (name, _) in enumerate(licences.FULL_TEXTS) for j in (0, 1, 2))
    assert not {6000, 6001, 6002} & set(got)


# 7


def test_decontamination_by_hand(spark):
    r = random.Random(4)
    say = lambda n: [f"t{r.randrange(40)}" for _ in range(n)]
    items = {k: say(n) for k, n in enumerate((40, 16, 25, 9, 7, 12, 30))}
    texts = {}
    for k in range(60):
        body = say(r.randrange(60))
        for item in r.sample(list(items.values()), r.randrange(3)):
            part = [w if r.random() < 0.9 else "x" for w in item[r.randrange(4) : len(item) - r.randrange(4)]]
            at = r.randrange(len(body) + 1)
            body[at:at] = part
        texts[k] = body
    want = {}
    for d, words in texts.items():
        for i, item in items.items():
            offsets = {
                p - q for p in range(len(words)) for q in range(len(item)) for m in decontamination.MASKS
                if p + len(m) <= len(words) and q + len(m) <= len(item) and all(words[p + j] == item[q + j] for j, c in enumerate(m) if c == "1")
            }
            enough = min(decontamination.MIN_SCORE, len(item) * decontamination.MIN_SHARE)
            for at in offsets:
                low, high = max(0, -at), min(len(item), len(words) - at)
                now = best = 0.0
                n = 0
                for j in range(low, high):
                    same = words[at + j] == item[j]
                    n += same
                    now = max(0.0, now + (1.0 if same else -decontamination.PENALTY))
                    best = max(best, now)
                if best >= enough:
                    want[d, i] = max(want.get((d, i), (0, 0, 0)), (best, n, high - low))
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()], "item_id long, text string")
    for few in (decontamination.BROADCAST_ROWS, 0):
        decontamination.BROADCAST_ROWS, before = few, decontamination.BROADCAST_ROWS
        try:
            got = {(x.doc_id, x.item_id): (x.score, x.n_matched, x.n_compared) for x in decontamination.decontaminate(df, bench).collect()}
        finally:
            decontamination.BROADCAST_ROWS = before
        assert got == want and len(want) > 20


# 9


def test_ftrl_by_hand():
    s = toxicity.Settings(l1=0.3, epochs=3, alpha=0.5)
    r = random.Random(6)
    texts = [" ".join(r.choice(["you", "bad", "good", "day", "Fool", "sun", "x1"]) for _ in range(r.randrange(12))) for _ in range(60)]
    labels = [int("bad" in t and "Fool" in t) for t in texts]
    rows = list(toxicity._rows(Words(pa.array(texts), lower=True, breaks=IS_MARK)))
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    bias = 1 << toxicity.BITS

    def weight(k):
        pull = 0.0 if k == bias else s.l1
        if k != bias and abs(z[k]) <= pull:
            return 0.0
        return -(z[k] - math.copysign(pull, z[k]) * (z[k] != 0)) / ((s.beta + math.sqrt(n[k])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for (at, x), label in zip(rows, labels, strict=True):
            w = [weight(k) for k in at.tolist()]
            p = 1 / (1 + math.exp(-max(-s.cap, min(s.cap, sum(a * b for a, b in zip(w, x.tolist(), strict=True))))))
            for k, v, own in zip(at.tolist(), x.tolist(), w, strict=True):
                g = (p - label) * v * (s.toxic_weight if label else 1.0)
                rate = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / s.alpha
                z[k] += g - rate * own
                n[k] += g * g
    at, w = toxicity.learn([(a, x, y) for (a, x), y in zip(rows, labels, strict=True)], s)
    want = {k: v for k in z if (v := weight(k)) != 0}
    assert set(at.tolist()) == set(want) and all(abs(want[k] - v) < 1e-6 for k, v in zip(at.tolist(), w.tolist(), strict=True)) and len(want) > 5


def test_repeated_ids_are_learned_from_once(spark):
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(40)], "doc_id long, toxic int")
    once = spark.createDataFrame([(k, f"a{k % 2} b c") for k in range(40)], "doc_id long, text string")
    s = toxicity.Settings(l1=0.1, max_rows=10)
    learned = lambda d: sorted(map(tuple, toxicity.train(d, labels, s).collect()))
    assert learned(once) == learned(once.unionAll(once).unionAll(once)) and learned(once)


def test_word_counts_of_windows_are_those_of_plain_loops():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60, 40).astype(np.uint64)) for _ in range(40)]
    labels = r.integers(0, 3, 40)
    linked = list(range(40))
    join = lambda a, b: [linked[a] if x == linked[b] else x for x in linked]
    for i in range(40):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if labels[i] == labels[j] or 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                linked = join(i, j)
    want, linked = linked, list(range(40))
    for i in range(40):
        for j in range(i):
            if labels[i] == labels[j]:
                linked = join(i, j)
    for i, j in jaccard.similar(sets, labels):
        linked = join(i, j)
    assert [[a == b for b in want] for a in want] == [[a == b for b in linked] for a in linked]


def similar_sets(a, b):
    both = len(np.intersect1d(a, b))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def test_members_kept_for_one_partner_keep_their_others():
    r = np.random.default_rng(4)
    for _ in range(100):
        pool = r.integers(0, 1 << 62, 100).astype(np.uint64)
        sets = [np.unique(pool[3 * k : 3 * k + 20 + int(r.integers(0, 2))]) for k in r.permutation(20)]  # only neighbours in the chain are similar
        labels = r.integers(0, 8, 20)
        vectors = [np.bincount((s & np.uint64(63)).astype(np.int64), minlength=64).astype(np.uint16).tobytes() for s in sets]
        ids = pa.array(range(20), pa.int64())
        block = {c: pa.array([0] * 20, pa.int64()) for c in jaccard.BLOCK} | {"id": ids, "label": pa.array(labels), "n": pa.array([len(s) for s in sets]), "vector": pa.array(vectors, pa.binary())}
        kept = {i for b in jaccard._with_partner(iter([pa.RecordBatch.from_pydict(block)])) for i in b["id"].to_pylist()}
        assert {k for i in range(20) for j in range(i) if labels[i] != labels[j] and similar_sets(sets[i], sets[j]) for k in (i, j)} <= kept


def test_chains_of_similar_texts_are_whole(spark):
    r = random.Random(5)
    rows, want = [], {}
    for c in range(150):
        words, step = ((18, 2), (24, 2), (64, 6))[c % 3]  # similarities of neighbours: 0.75, 0.82 and 0.82
        ids = [10 * c + j for j in range(r.choice((3, 4, 5)))]
        want |= dict.fromkeys(ids, ids[0])
        r.shuffle(ids)
        rows += [(i, " ".join(f"w{c}x{m}" for m in range(step * j, step * j + words))) for j, i in enumerate(ids)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_join(df).collect()} == want


def test_queries_return_their_columns(spark):
    wanted = {
        "op2_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], "op3_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op8_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"], "op9_toxicity": ["doc_id", "held_out", "score", "predicted"], "op10_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    }
    for name in ("op2_bpe", "op8_substring_dedup"):
        assert queries.queries()[name](spark, DATA).columns[: len(wanted[name])] == wanted[name]
    assert quality.quality_rules(spark.read.parquet(f"{DATA}/documents.parquet")).columns[:8] == wanted["op3_quality"]
