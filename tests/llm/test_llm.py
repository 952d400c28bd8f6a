"""Each operator against a brute-force version or the public library, with nulls, empties, repeats and odd columns."""

import collections
import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from siltstone.llm import bpe, chat, decontamination, jaccard, licences, quality, queries, sql, substrings, token_counts, toxicity, url_filter
from siltstone.llm.common import Scratch
from siltstone.llm.components import components

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fixture_texts() -> list[tuple]:
    r = random.Random(7)
    vocabulary = ["the", "of", "Word", "ñandú", "x,", "Über", "z\u00a0z", "a" * 40, *(f"w{k}" for k in range(60))]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, base = say(30), say(60)
    texts = [None, "", " \n\t ", "one two three", "one two three", passage, f"{say(5)} {passage} {say(9)}", f"{passage}\n{passage}", base, base + " end", base.upper(), say(4000), "x" * 5000]
    for _ in range(30):
        words = base.split(" ")
        for _ in range(r.randrange(3)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        texts.append(r.choice(["\n", " ", "\t \x0b"]).join(words))
    texts += [say(r.randrange(1, 120)) for _ in range(60)] + ["ab " * 100]
    return [(k, t, r.choice(["en", "de", None]), f"src{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_texts(), "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


@pytest.fixture(scope="module")
def clashing(docs):
    """The same with columns that operators might use themselves, a row without an id, and repeated rows."""
    odd = docs.select("*", *[F.lit(1).alias(c) for c in ("id", "f", "ref", "ranges", "kept", "h", "component", "words", "word", "key")])
    return odd.unionByName(odd.where("doc_id in (5, 8)")).unionByName(odd.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))


def texts_of(df) -> dict:
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_queries_are_named_and_sql_belongs_to_them():
    found = queries.queries()
    assert [sum(n.startswith(f"op{k}_") for n in found) for k in range(1, 11)] == [1] * 10
    assert set(sql.ORACLES) <= set(found)


# 1


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "http://EXAMPLE.net/en/x?y#z", "https://a.example.net/de/", "x://b.example.com/de/1", "http://b.example.com/de", "http://spam-farm.example.org/fr/", "http://www.spam-farm.example.org/en", "http://notspam-farm.example.org/", "http://h?://q", "http://a.b.net", "http://.net/", "http://xnet/"]
    urls += [f"http://h{k}.d{k % 7}.example.org/p{k}" for k in range(300)] + ["http://www.spam-farm.example.org/en"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1)).withColumn("blocked", F.lit(2))
    listed = [*url_filter.LISTED_HOSTS, *(f"d{k}.example.org" for k in (1, 4)), "h9.d2.example.org"]

    def judge(url):
        host, path = host_and_path(url)
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fits:
            return host, path, *max(fits)[1:]
        return host, path, None, "block" if any(host == x or host.endswith("." + x) for x in listed) else "allow"

    for bits, chunk in ((url_filter.MAX_BITS, 1), (64, 1), (64, 2)):  # as a constant, and as arrays of their own
        got = {r[0]: tuple(r)[1:] for r in url_filter.url_filter(pages, listed=listed, max_bits=bits, chunk=chunk).collect()}
        assert got == {k: judge(u) for k, u in enumerate(urls)}
    assert url_filter.url_filter(pages.limit(0)).count() == 0
    assert url_filter.url_filter(pages, listed=[]).where("verdict = 'block' and rule is null").count() == 0


def test_cascade_is_exact_for_its_universe(spark):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 9 == 0).alias("listed"))
    levels = url_filter.build_cascade(keys)
    assert len(levels) > 2
    assert keys.where(url_filter.in_cascade(levels, F.col("key")) != F.col("listed")).count() == 0


# 2


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_matches_the_library(docs, clashing, library):
    for frame in (docs, clashing):
        rows, texts = bpe.bpe_encode(frame).collect(), texts_of(frame)
        assert len(rows) == frame.count()
        for r in rows:
            if r.doc_id is None:
                continue
            ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert bpe.bpe_encode(docs.limit(0)).count() == 0


def test_bpe_of_long_words_and_small_budgets(library, monkeypatch):
    r = random.Random(8)
    texts = ["".join(r.choice("abcdé漢字 ") for _ in range(k)) for k in (3000, 200, 5000)] + ["ab" * 4000, "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(20_000))]
    monkeypatch.setattr(bpe, "MAX_NODES", 50)
    monkeypatch.setattr(bpe, "MAX_BYTES", 1000)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 100)
    e = bpe.Encoder(bpe.tokenizer_text())
    for t in texts * 2:
        words = e.words(t)
        e.learn([words])
        assert [int(i) for w in words for i in e.ids[w].split(",")] == library.encode(t, add_special_tokens=False).ids
        assert e.decoded(t, words).decode() == t and not e.odd and len(e.trie.last) < 2500


def test_bpe_round_trip_and_special_tokens(spark, library):
    r = random.Random(3)
    pieces = ["the", "ing", "don't", "I'LL", " ", "\n", "  ", "<|endoftext|>", "123", "漢字", "🙂", "\u0300", "\x1c", "\u3000", "é", "aaaa", "--", "\u200b"]
    texts = ["".join(r.choice(pieces) if r.random() < 0.7 else chr(r.randrange(32, 0xD7FF)) for _ in range(r.randrange(25))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = bpe.bpe_encode(df, with_ids=True)
    got = {x.doc_id: x.ids for x in encoded.collect()}
    assert [got[k] for k in range(len(texts))] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert texts_of(bpe.bpe_decode(encoded)) == dict(enumerate(texts))


# 3


def base_counts(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    repeated = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_counts(docs, clashing):
    for frame in (docs, clashing):
        texts = texts_of(frame)
        for r in quality.quality_rules(frame).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(texts[r.doc_id])
            assert not (r.base_failed and r.kept)
    carried = quality.quality_rules(clashing, carry=True)
    assert carried.columns == [*clashing.columns, "kept_"] and carried.count() == clashing.count()
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_quality_tells_good_from_bad(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.quality_rules(d).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] > 0.99 and kept[0] < 0.5


def test_js_distance(spark):
    d = lambda a, b: spark.range(1).select(quality.js_distance(F.array(*map(F.lit, a)), F.array(*map(F.lit, b)))).first()[0]
    assert d([1.0, 0.0], [0.0, 5.0]) == 1.0 and d([1.0, 3.0], [2.0, 6.0]) == 0.0 and d([0.0, 0.0], [1.0, 1.0]) == 0.0
    assert abs(d([1.0, 1.0], [1.0, 0.0]) - 0.5579230452841438) < 1e-12


# 4


def test_licences_and_inheritance(spark):
    files = [
        (1, "r/LICENSE", "x\nReleased under the MIT License.\ny"), (2, "r/a/b/f.py", "code"), (3, "r/a/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        (4, "r/a/b/g.py", "# Licensed under the Apache License, Version 2.0."), (5, "q/f.py", None), (6, None, ""), (7, "r/h.py", "Licensed under CC BY-NC 4.0."), (8, "r/ab/i.py", "a licensed plumber came"),
    ]
    df = spark.createDataFrame(files, "doc_id long, p string, text string").withColumn("licence", F.lit("x")).withColumn("path", F.lit("y"))
    got = {r.doc_id: (r.licence, r.origin, r.origin_dir) for r in licences.licence_scan(df, F.col("p")).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("GPL-3.0", "inherited", "r/a"), 3: ("GPL-3.0", "own", None), 4: ("Apache-2.0", "own", None), 5: (None, None, None), 6: (None, None, None), 7: ("CC-BY-NC-4.0", "own", None), 8: ("MIT", "inherited", "r"),
    }
    assert licences.licence_scan(df.limit(0), F.col("p")).count() == 0
    assert licences.licence_scan(df.unionByName(df), F.col("p")).count() == 16


def test_licences_inside_lines_and_over_lines(spark):
    r = random.Random(3)
    other = lambda n: " ".join(f"w{r.randrange(500)}" for _ in range(n))
    texts = [(k, f"{other(r.choice([0, 5, 200]))} {body} {other(150)}", name) for k, (name, body) in enumerate(licences.TEMPLATES)]
    texts += [(100 + k, f"{other(90)}\n# " + body.replace(" ", "\n# ") + f"\n{other(90)}", name) for k, (name, body) in enumerate(licences.TEMPLATES) if "SPDX" not in body]
    texts += [
        (300, f"{other(80)} a license that came {other(80)} is distributed under the MIT License and was {other(80)}", "MIT"), (301, f"{other(9)} SPDX-License-Identifier: (MPL-2.0 OR MIT) {other(60)}", "MPL-2.0"),
        (302, f"{other(80)} a license, the copyright and the redistribution of it under the license {other(80)}", None), (303, f"{other(9)} SPDX-License-Identifier: Other-1.0 {other(60)}", None), (304, other(90), None),
    ]
    df = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    got = {x.doc_id: (x.licence, x.score) for x in licences.own_licences(df).collect()}
    assert {k: got.get(k, (None,))[0] for k, _, _ in texts} == {k: name for k, _, name in texts}
    assert all(got[k][1] == 1.0 for k in got if k < 300)


def test_licence_lines_of_the_tables(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = {r.doc_id: r.licence for r in licences.own_licences(d).collect()}
    phrases = {"Apache License, Version 2.0.": "Apache-2.0", "under the MIT License.": "MIT", "General Public License, version 3.": "GPL-3.0", "CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    for k, t in texts_of(d).items():
        said = {v for p, v in phrases.items() if p in t}
        assert own.get(k) in said if said else k not in own


# 5


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "Ann", "yo"), (1, 1, "user", None), (1, 2, None, "?"), (1, 2, None, "?"), (2, None, "user", "a"), (1, 70, "Ann", "late"), (None, 0, "x", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit(9))
    got = {(r.conv_id, r.speaker, r.block): r for r in chat.rotate_perspectives(df).collect()}
    assert set(got) == {(1, s, b) for s in ("user", "Ann", "unknown") for b in (0, 1)} | {(2, "user", -1), (None, "x", 0)}
    ann = got[1, "Ann", 0]
    assert ann.rendered == "<|user name=user|>\nhi\n<|end|>\n<|assistant|>\nyo\n<|end|>\n<|user name=user|>\n\n<|end|>\n<|user name=unknown|>\n?\n<|end|>\n"
    for r in got.values():
        said = [r.rendered[m.start : m.start + m.length] for m in r.masks]
        assert len(said) == r.n_own and "".join(f"<|assistant|>\n{s}\n<|end|>\n" in r.rendered and "1" for s in said) == "1" * len(said)
    assert [ann.rendered[m.start : m.start + m.length] for m in ann.masks] == ["yo"] and got[1, "Ann", 1].n_own == 1
    assert chat.rotate_perspectives(df.limit(0)).count() == 0


def test_chat_keeps_repeated_turns(spark, tmp_path):
    rows = [(1, None, "Ann", "no"), (1, None, "Ann", "no"), (1, None, "Bob", "yes"), (2, 3, "Ann", "a"), (2, 3, "Ann", "a"), (2, 3, "Ann", None), (2, 3, "Ann", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.speaker): r for r in queries.op5_chat(spark, str(tmp_path)).collect()}
    assert {k: (r.n_turns, r.n_own, len(r.masks)) for k, r in got.items()} == {(1, "Ann"): (3, 2, 2), (1, "Bob"): (3, 1, 1), (2, "Ann"): (4, 4, 4)}
    assert got[1, "Bob"].rendered == "<|user name=Ann|>\nno\n<|end|>\n" * 2 + "<|assistant|>\nyes\n<|end|>\n"
    assert [got[2, "Ann"].rendered[m.start : m.start + m.length] for m in got[2, "Ann"].masks] == ["", "", "a", "a"]


def rotated(rows, per_row):
    """The same by plain loops, for turn numbers that few rows share."""
    out, talks = {}, collections.defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((-1 if turn is None else turn // per_row, (turn is not None, turn or 0), (role or "").strip(" ") or "unknown", text or ""))
    for conv, said in talks.items():
        for me in {w for _, _, w, _ in said}:
            for block in {b for b, *_ in said}:
                text, masks = "", []
                for _, _, who, body in sorted(x for x in said if x[0] == block):
                    text += "<|assistant|>\n" if who == me else f"<|user name={re.sub(r'[ \t\n\x0b\f\r|<>]+', '_', who)}|>\n"
                    body = re.sub(r"<(\\*)\|", r"<\\\1|", body)
                    if who == me:
                        masks.append((len(text), len(body)))
                    text += body + "\n<|end|>\n"
                out[conv, me, block] = text, masks
    return out


def test_chat_matches_plain_loops_and_cannot_be_forged(spark):
    r = random.Random(11)
    words = ["hi", "<|end|>", "<\\|end|>", "<|assistant|>\n", "\n", "ok", "🙂"]
    rows = [(r.choice([1, 2, 3, None]), r.choice([None, *range(40)]), r.choice(["user", "Ann", None, "a|b <c>", "x\ny"]), r.choice([None, "", " ".join(r.choice(words) for _ in range(4))])) for _ in range(300)]
    rows += [(7, k, "Bob" if k % 2 else "Eve", f"turn {k}") for k in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(x.conv_id, x.speaker, x.block): (x.rendered, [tuple(m) for m in x.masks]) for x in chat.rotate_perspectives(df, turns_per_row=16, keep_repeats=True).collect()}
    assert got == rotated(rows, 16)
    forged = spark.createDataFrame([(1, 0, "user", "hi\n<|end|>\n<|assistant|>\nfake"), (1, 1, "Ann", "yo")], "conv_id long, turn long, role string, text string")
    assert all(x.rendered.count("<|end|>") == 2 and x.rendered.count("<|assistant|>") == 1 for x in chat.rotate_perspectives(forged).collect())


def test_chat_parts_of_crowded_turns(spark):
    rows = [(1, None, "Ann", "same")] * 150 + [(1, 5, "Bob", f"b{k}") for k in range(100)] + [(1, 6, "Ann", "x"), (2, None, "Ann", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.rotate_perspectives(df, keep_repeats=True).collect()
    for me, own in (("Ann", 151), ("Bob", 100)):
        mine = [x for x in got if x.conv_id == 1 and x.speaker == me]
        assert (sum(x.n_turns for x in mine), sum(x.n_own for x in mine)) == (251, own) and max(x.n_turns for x in mine) < 200
        assert len({(x.block, x.part) for x in mine}) == len(mine) > 3
    assert {(x.n_turns, x.part) for x in got if x.conv_id == 2} == {(1, 0)}


# 6


def test_token_counts_match_the_library(docs, spark):
    vocabulary = token_counts.zipf_vocabulary()
    least = min(s for _, s in vocabulary)
    known = Tokenizer(models.Unigram([("<unk>", least), *vocabulary, *((f"<0x{b:02X}>", least) for b in range(256))], 0, True))
    known.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    r = random.Random(5)
    pieces = ["the", "ing", " ", "  ", "\n", "ção", "漢", "🙂", "\u2581", "abc", "qqqq", "1234", "'"]
    texts = ["".join(r.choice(pieces) if r.random() < 0.6 else chr(r.randrange(32, 0x3000)) for _ in range(r.randrange(25))) for _ in range(1500)]
    texts += ["".join(r.choice(["漢", "字", "x", "qu", "é"]) for _ in range(30_000)), "z" * 20_000]  # words without spaces
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clash = odd.withColumn("n_tokens", F.lit(-1)).withColumn("key", F.lit("x"))
    assert token_counts.token_counts(clash).columns == ["doc_id", "n_tokens"]
    frames = [odd, clash.drop("n_tokens"), docs]
    for frame in frames:
        for row in token_counts.token_counts(frame).join(frame, "doc_id").collect():
            assert row.n_tokens == len(known.encode(row.text or "", add_special_tokens=False).ids)
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def test_token_count_ties_take_the_earlier_start():
    c = token_counts.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("c", -2.0), ("bc", -3.0), ("\u2581", 0.0)])
    assert c.count("ab") == 1 and c.count("abc") == 2 and c.count("é") == 2 and c.count("") == 0


# 7


def test_decontamination(spark):
    r = random.Random(1)
    say = lambda n: [f"t{r.randrange(500)}" for _ in range(n)]
    items = {k: say(n) for k, n in enumerate((40, 16, 25, 5))}
    changed = list(items[0])
    for k in (6, 13, 20, 27, 34):
        changed[k] = "other"
    texts = {
        1: say(200), 2: say(50) + items[0] + say(50), 3: say(20) + changed + say(3), 4: items[1], 5: say(10) + items[2][:15] + say(10), 6: None, 7: "", 8: [w.upper() + "," for w in items[2]], 9: say(30) + items[0][:4] + say(30), 10: say(5) + items[3] + say(5), 11: items[0] * 3,
    }
    rows = [(k, " ".join(t) if t else t) for k, t in texts.items()]
    df = spark.createDataFrame([*rows, rows[1], (None, rows[1][1])], "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("item", F.lit(2))
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()] + [(9, None), (10, "")], "item_id long, text string")
    found = decontamination.decontaminate(df, bench)
    got = {(x.doc_id, x.item_id): x.n_matched for x in found.collect()}
    assert got == {(2, 0): 40, (3, 0): 35, (4, 1): 16, (5, 2): got[5, 2], (8, 2): 25, (11, 0): 40} and got[5, 2] >= 15
    left = decontamination.without_leaks(df, found)
    assert left.columns == df.columns and sorted(x.doc_id or 0 for x in left.collect()) == [0, 1, 6, 7, 9, 10]
    assert decontamination.decontaminate(df.limit(0), bench).count() == 0 == decontamination.decontaminate(df, bench.limit(0)).count()


def test_short_items(spark, tmp_path):
    texts = {1: "a b c d e f", 2: "x, A b? x a b", 3: "b a", 4: "q one two three four five six q", 5: "q one two three four five seven", 6: None, 7: " ".join(f"t{k}" for k in range(30)), 8: "ab"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "a b"), (2, "one two three four five six"), (3, texts[7]), (4, ""), (5, None), (6, "d")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(x.doc_id, x.item_id): (x.n_matched, x.n_compared, x.score) for x in queries.op7_decontamination(spark, str(tmp_path)).collect()}
    assert got == {(1, 1): (2, 2, 2.0), (2, 1): (2, 2, 2.0), (1, 6): (1, 1, 1.0), (4, 2): (6, 6, 6.0), (7, 3): (30, 30, 30.0)}


def test_decontamination_of_the_tables(spark):
    d, b = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    held = {(k, r.item_id) for k, t in texts_of(d).items() for r in b.collect() if r.text in (t or "")}
    found = {(r.doc_id, r.item_id) for r in decontamination.decontaminate(d, b).collect()}
    assert held and held <= found


# 8


def without_repeats(texts: dict, window: int = 20) -> dict:
    """Words and which are cut, from ids in order."""
    seen, out = {}, {}
    for k in sorted(texts):
        words = WORD.findall(texts[k] or "")
        cut = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[i : i + window]), (k, i)) != (k, i):
                cut[i : i + window] = [True] * window
        out[k] = words, cut
    return out


@pytest.mark.parametrize("window", [20, 5, 2])
def test_substring_dedup(docs, window):
    want = without_repeats(texts_of(docs), window)
    rows = {r.doc_id: r for r in substrings.substring_dedup(docs, window, digest=True).collect()}
    texts = texts_of(substrings.substring_dedup(docs, window))
    for k, (words, cut) in want.items():
        kept = [w for w, c in zip(words, cut, strict=True) if not c]
        assert tuple(rows[k])[1:] == (len(words), sum(cut), sha(" ".join(kept)))
        assert WORD.findall(texts[k] or "") == kept


def test_substring_dedup_edges(docs, clashing):
    out = substrings.substring_dedup(clashing)
    assert out.columns == clashing.columns and out.dtypes == clashing.dtypes and out.count() == clashing.count()
    plain, odd = texts_of(substrings.substring_dedup(docs)), out.where("doc_id is null").first().text
    assert odd == texts_of(docs)[5]  # a row without an id is left alone
    assert {k: v for k, v in texts_of(out).items() if k is not None} == plain  # repeated rows don't cut one another
    assert substrings.substring_dedup(docs.limit(0), digest=True).count() == 0


# 9


def test_toxicity(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(d, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    ranks = rows.score.rank()
    n = int(rows.toxic.sum())
    assert (ranks[rows.toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(rows) - n)) > 0.95
    assert (rows.predicted == rows.toxic).mean() > 0.95 and rows[rows.predicted == 1].toxic.mean() > 0.95


def test_toxicity_edges(spark, clashing):
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 1), (8, 0, None), (None, 1, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(clashing, labels).collect()
    assert len(rows) == clashing.count() and all(0 <= r.score <= 1 for r in rows) and {r.held_out for r in rows} == {True, False}
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert {r.score for r in toxicity.toxicity(clashing, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(clashing.limit(0), labels).count() == 0


# 10


def linked(texts: dict) -> dict:
    sets = {}
    for k, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER))
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {k: (len(sets[k]), label[k]) for k in sets}


@pytest.mark.parametrize(("tile", "hot"), [(jaccard.TILE, jaccard.HOT_LEVEL), (6, 3)])
def test_jaccard_join(docs, clashing, tile, hot, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "HOT_LEVEL", hot)
    want = linked(texts_of(docs))
    assert {r.doc_id: tuple(r)[1:] for r in jaccard.jaccard_join(docs).collect()} == want
    assert len({c for _, c in want.values()}) < len(want) - 10
    rows = jaccard.jaccard_join(clashing).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want and len(rows) == clashing.where("doc_id is not null").count()
    assert jaccard.jaccard_join(docs.limit(0)).count() == 0


def test_similar_sets_connect_without_all_pairs():
    import numpy as np

    r = np.random.default_rng(1)
    base = np.unique(r.integers(0, 1 << 62, 400).astype(np.uint64))
    sets = [np.unique(np.concatenate([r.choice(base, int(380 - 60 * (k % 5 == 0)), replace=False), r.integers(0, 1 << 62, 10 + 40 * (k % 7 == 0)).astype(np.uint64)])) for k in range(120)]
    pairs = list(jaccard.similar(sets))
    label = list(range(120))
    for i, j in pairs:
        assert len(np.intersect1d(sets[i], sets[j])) * 100 >= 75 * len(np.union1d(sets[i], sets[j]))
        label = [label[i] if x == label[j] else x for x in label]
    for i in range(120):
        for j in range(i):
            if len(np.intersect1d(sets[i], sets[j])) * 100 >= 75 * len(np.union1d(sets[i], sets[j])):
                assert label[i] == label[j]
    assert len(pairs) < 120


def test_components(spark):
    links = [(k, k + 1) for k in range(200) if k % 20 != 19] + [(500, 3), (3, 500), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df, Scratch(spark)).collect()}
    assert got == {k: k // 20 * 20 for k in range(200)} | {500: 0}
    assert components(df.limit(0), Scratch(spark)).count() == 0


# the pipeline


def test_repeated_rows_in_the_pipeline(spark):
    import corpus_pipeline

    say = lambda k: " ".join(f"w{k}x{n}" for n in range(40))
    rows = [(1, say(1), "en", "a", 5), (1, say(1), "en", "b", 5), (1, say(2), "en", "a", 5), (2, say(3), None, None, None), (None, say(4), "en", "a", 5), (None, say(4), "en", "a", 5), (3, None, "en", "a", 5), (3, None, "en", "a", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_duplicates(spark, df, DATA)
    assert left.columns == df.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, df.where("source = 'a' or source is null").distinct().collect()))
    assert corpus_pipeline.near_duplicates(spark, df.where("doc_id = 2"), DATA).count() == 1


def test_stages_take_odd_tables(spark):
    import corpus_pipeline

    say = lambda k, n=60: " ".join(f"w{k}x{(j * j + k) % 97}" for j in range(n))
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", "s", None), (3, say(3), "en", None, 1), (3, say(3), "en", "t", 2), (4, say(4), None, "s", 3), (None, say(5), "en", "s", 4), (6, say(6, 5000), "en", "s", 5), (7, say(6, 5000) + " end", "en", "s", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(("again", "rest", "kept", "id", "ranges", "component_id", "item_id", "f", "c0"))])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, DATA)
        assert out.columns == odd.columns, name
        ids = sorted(r.doc_id or 0 for r in out.collect())
        want = {"quality rules": [0, 3, 3, 4], "n-gram Jaccard join": [0, 0, 1, 2, 3, 4, 6]}.get(name, [0, 0, 1, 2, 3, 3, 4, 6, 7])
        assert ids == want or name == "quality rules" and set(ids) <= {0, 3, 4, 6, 7}, name
        assert stage(spark, odd.limit(0), DATA).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, DATA).count() == len(rows)


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    scratch, columns = Scratch(spark), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = texts_of(docs)
        out = stage(spark, docs, DATA)
        if name.startswith("BPE"):
            break
        docs = scratch.save(out)
        assert docs.columns == columns
        after = texts_of(docs)
        if name == "quality rules":
            assert all(not base_counts(t)[-1] for t in after.values()) and set(after) <= set(before)
        elif name == "n-gram Jaccard join":
            assert set(after) == {c for _, c in linked(before).values()}
        elif name == "substring dedup":
            want = without_repeats(before)
            assert {k: WORD.findall(t) for k, t in after.items()} == {k: [w for w, c in zip(*v, strict=True) if not c] for k, v in want.items()}
            assert docs.where("n_chars <> length(text)").count() == 0
    rows = {r.doc_id: r for r in out.collect()}
    assert {k: r.decoded_sha256 for k, r in rows.items()} == {k: sha(t) for k, t in after.items()}
    assert {k: r.ids_sha256 for k, r in rows.items()} == {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, DATA).collect()}
