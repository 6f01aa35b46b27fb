"""Archives, spelling variants and phrases against brute force, with nulls, empty tables, ties and repeated rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tablegauge.llm import collocations, spelling, warc

# Archives

PAGES = "page_id long, url string, html string, size long, sha string, body int, file string"


def archive_pages(spark, rows, parts=3):
    return spark.createDataFrame([(i, u, h, 1, "x", 2, "y") for i, u, h in rows], PAGES).repartition(parts)


def tricky_pages():
    random.seed(8)
    inner = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: {}\r\n\r\n"
    rows = [(i, f"http://h/{i}", "<p>" + "ab é " * random.randint(0, 60)) for i in range(60)]
    rows += [(100, "http://x/WARC/1.0", ""), (101, None, None), (102, "a b\r\nWARC/1.0\r\n", "\r\n\r\n"), (103, "http://x/", "W")]
    # Magic inside payloads: before everything, after everything, with lengths that lead astray or back to the chain.
    rows += [(200 + n, "u", "before " + inner.format(n) + "z" * 40) for n in (0, 3, 40, 10**9)]
    rows += [(300, "u", "WARC/1.0\r\n"), (301, "u", "WARC/1.0\r\n" * 30), (302, "u", "x\r\n\r\nWARC/1.0\r\n"), (303, "u", "WARC/1.")]
    rows += [(400, "u", "same"), (401, "u", "same"), (402, "v", "same"), (402, "v", "same"), (None, "n", "same"), (None, "n", "alone")]
    return rows


def brute_archive(rows):
    tops = defaultdict(list)
    for i, _, h in rows:
        tops[h or ""].append(i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        top = max((x for x in tops[h or ""] if x is not None), default=None)
        again = i != top
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("range_bytes", ["128m", "1k", "97"])
def test_archives_give_back_every_page(spark, range_bytes):
    spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = tricky_pages()
        got = warc.round_trip(archive_pages(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got), key=str) == brute_archive(rows)


def test_archives_are_what_the_format_says(spark, tmp_path):
    rows = tricky_pages()
    path = str(tmp_path / "w")
    warc.write_archives(archive_pages(spark, rows, 2), path)
    found = []
    for file in tmp_path.glob("w/part-*"):
        data, at = file.read_bytes(), 0
        while at < len(data):
            head, _, _ = data[at:].partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            start = at + len(head) + 4
            block = data[start : start + int(fields[b"Content-Length"])]
            assert data[at : at + 10] == b"WARC/1.0\r\n" and data[start + len(block) :][:4] == b"\r\n\r\n"
            found.append((fields[b"WARC-Type"], block.partition(b"\r\n\r\n")[2]))
            at = start + len(block) + 4
    kinds = Counter(r[3] for r in brute_archive(rows))
    assert Counter(k.decode() for k, _ in found) == kinds
    whole = Counter(b for k, b in found if k == b"response")
    records = warc.find_records(spark, path)
    bodies = warc.payloads(spark, path, records)
    assert Counter(bytes(r.payload) for r in bodies.collect()) == whole
    sound = {r.sound for r in records.collect()}
    assert sound == {True, None}
    urls = {r.url for r in records.collect()}
    assert "http://x/WARC/1.0" in urls and "a%20b%0D%0AWARC/1.0%0D%0A" in urls and None in urls


def test_a_broken_chain_is_told(spark, tmp_path):
    good = "WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for name, text, broken in [("a", good * 4, False), ("b", good * 2 + good[:-9], True), ("c", "x" + good, True), ("d", "", False)]:
        folder = tmp_path / name
        folder.mkdir()
        (folder / "f.warc").write_bytes(text.encode())
        if broken:
            with pytest.raises(ValueError, match="ends early"):
                warc.find_records(spark, str(folder)).collect()
        else:
            assert warc.find_records(spark, str(folder)).count() == text.count("abc")


def test_short_payloads_may_stay_responses(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    planned = warc.plan_records(archive_pages(spark, rows), least_bytes=3).collect()
    assert [(r.page_id, r.response) for r in planned] == [(3, 4)]


def test_chain_numbers_tell_ways():
    random.seed(2)
    for _ in range(200):
        at = sorted(random.sample(range(60), random.randint(1, 15)))
        after = [random.choice([None, *[p for p in at if p > a], 60, 77]) for a in at]
        out, low, high = warc.chain_numbers(at, after)
        step = dict(zip(at, after))
        for i, e in enumerate(at):
            way, p = set(), e
            while p in step:
                way.add(p)
                p = step[p]
            assert out[i] == p
            assert {at[j] for j in range(len(at)) if low[j] <= low[i] <= high[j]} == way


def test_no_pages(spark):
    got = warc.round_trip(archive_pages(spark, []))
    assert got.count() == 0 and got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_text_ids(spark):
    frame = spark.createDataFrame([("a b%\r\n", b"\xff\x00WARC/1.0\r\n"), ("z", b"\xff"), ("é<>", b"\xff")], "page_id string, html binary")
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect()}
    assert got == {"a b%\r\n": (12, "response", None), "z": (1, "revisit", "é<>"), "é<>": (1, "response", None)}


# Spelling variants

DOCS = "doc_id long, text string, lang string, word string, n long, letters string"


def spelling_docs():
    random.seed(4)
    letters = "abcdé"
    base = ["".join(random.choices(letters, k=random.randint(6, 9))) for _ in range(60)]
    texts = []
    for i in range(400):
        words = random.choices(base, k=20)
        for j in range(len(words)):
            if random.random() < 0.25:
                w, at = words[j], random.randrange(len(words[j]))
                words[j] = random.choice([w[:at] + w[at + 1 :], w[:at] + random.choice(letters) + w[at:], w[:at] + random.choice(letters) + w[at + 1 :]])
        texts.append(random.choice([" ", "-", "1"]).join(words).upper().replace("É", "é") if i % 3 else " ".join(words))
    texts += [None, "", "x", "short words only", "ÀÿÀÿÀÿ Straße×÷ " * 6, "q" * 5000 + " " + "q" * 5001]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4])]


def brute_variants(rows, deleting=199):
    total = Counter()
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for w in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if deleting and h % deleting == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    words = {w: n for w, n in total.items() if n >= 5 and len(w) >= 6}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = [], {}
    links = {w: [o for o in words if near(w, o)] for w in words}
    for w, n in words.items():
        best = min(links[w], key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(links[w]), words[form[w]] if w in form else None))
    return sorted(out)


def test_variants_equal_brute_force(spark):
    rows = spelling_docs()
    docs = spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in rows], DOCS).repartition(5)
    got = sorted(map(tuple, spelling.group_variants(docs).collect()))
    want = brute_variants(rows)
    assert got == want and sum(r[1] is not None for r in want) > 5


@pytest.mark.parametrize("parts,limit", [(3, 1), (4, 8), (8, 1024)])
def test_multisets_meet_at_every_bucket_limit(spark, monkeypatch, parts, limit):
    monkeypatch.setattr(spelling, "MOST_PARTS", 12)
    random.seed(parts)
    sets = sorted({"".join(sorted(random.choices("abcdef", k=random.randint(4, 7)))) for _ in range(250)})
    frame = spark.createDataFrame([(s,) for s in sets], "letters string").repartition(3)
    got = sorted(map(tuple, spelling.close_multisets(frame, parts, limit).collect()))
    want = []
    for a in sets:
        for b in sets:
            lost, gained = spelling.difference(a, b)
            if len(lost) == 1 and (len(gained) == 0 or (len(gained) == 1 and a < b)):
                want.append((a, b, lost, gained))
    assert got == sorted(want)


def test_roots_follow_long_ways(spark):
    forms = [(f"w{i:03}", f"w{i + 1:03}") for i in range(40)] + [("a", "w000"), ("b", "w039")]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()))
    assert got == {w: "w040" for w, _ in forms}


def test_no_words(spark):
    assert spelling.group_variants(spark.createDataFrame([], DOCS)).count() == 0
    assert spelling.group_variants(spark.createDataFrame([(1, None, "x", "y", 1, "z")], DOCS)).count() == 0


# Phrases

TEXTS = "doc_id long, text string, lang string, phrase string, n long, words int"


def phrase_rows():
    random.seed(6)
    words = ["new", "york", "city", "the", "of", "é", "Zoo", "a-b", "x\x00y", " ", "ÀB"]
    texts = []
    for i in range(300):
        said = random.choices(words, [9, 9, 6, 5, 5, 3, 3, 2, 1, 1, 1], k=random.randint(0, 60))
        texts.append("".join(w + random.choice([" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\x0b"]) for w in said))
    texts += ["new york city hall " * 60, "new york " * 3 + "." + "new york" * 2, None, "", " \t", "...", "solo"]
    return [(i, t, random.choice(["en", "en", "de", None, ""])) for i, t in enumerate(texts)] + [(0, texts[0], "en")] * 2


def brute_phrases(rows, least, per_lang):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^ \t]+", piece)
            totals[lang] += len(ws)
            for n in range(1, 5):
                for i in range(len(ws) - n + 1):
                    counts[lang, tuple(ws[i : i + n])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, ws), f in found.items():
        for n in range(2, len(ws)):
            for i in range(len(ws) - n + 1):
                if 100 * f >= 80 * counts[lang, ws[i : i + n]]:
                    gone.add((lang, ws[i : i + n]))
    ranked = defaultdict(list)
    for (lang, ws), a in found.items():
        if (lang, ws) not in gone:
            s, k = min((2_000_000 * a // (counts[lang, ws[:k]] + counts[lang, ws[k:]]), k) for k in range(1, len(ws)))
            ranked[lang].append((-s, -a, " ".join(ws).encode(), counts[lang, ws[:k]], counts[lang, ws[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, totals[lang], -s)
        for lang, rows in ranked.items()
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:per_lang], 1)
    )


@pytest.mark.parametrize("one_in,bits,least,per_lang", [(1, 64, 5, 2000), (3, 1 << 10, 30, 7), (16, 1 << 20, 2, 2000)])
def test_phrases_equal_brute_force(spark, monkeypatch, one_in, bits, least, per_lang):
    monkeypatch.setattr(collocations, "RANKED_TOGETHER", 20)
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TEXTS).repartition(4)
    got = collocations.mine(docs, least=least, per_lang=per_lang, one_in=one_in, bits=bits)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, per_lang)


def test_chunks_hold_every_word_once_behind_the_overlap():
    random.seed(9)
    text = " ".join(random.choices(["a", "bb", "ccc", "d.", "e"], k=3000)).encode()
    words = collocations.Words(np.frombuffer(text, dtype=np.uint8), np.array([0, 1000, len(text)]))
    for one_in in (1, 2, 16, 10**6):
        first, last, opens = collocations.cut_chunks(words, 3, one_in)
        own = [np.arange(f if o else f + 3, l + 1) for f, l, o in zip(first, last, opens)]
        assert (np.concatenate(own) == np.arange(len(words.starts))).all()
        assert words.new_piece[first[opens]].all()


def test_equal_text_is_cut_alike():
    random.seed(10)
    middle = " ".join(str(random.randint(0, 50)) for _ in range(300))

    def chunks(text):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        words = collocations.Words(data, np.array([0, len(data)]))
        first, last, _ = collocations.cut_chunks(words)
        return {words.data[words.starts[f] : words.ends[l]].tobytes() for f, l in zip(first, last)}

    a, b = chunks("left of it " + middle + " and on"), chunks("other words " + middle + " end")
    assert len(a & b) >= len(a) - 2


def test_hash_of_a_slice_depends_on_its_bytes():
    data = np.frombuffer(b"one two one two", dtype=np.uint8)
    hashes = collocations.Hashes(data).of(np.array([0, 8, 4, 12]), np.array([3, 11, 7, 15]))
    assert hashes[0] == hashes[1] != hashes[2] == hashes[3]
    assert collocations.slices_of(data, np.array([4, 0]), np.array([7, 3])).to_pylist() == ["two", "one"]
    assert collocations.slices_of(data, np.array([], dtype=int), np.array([], dtype=int)) == pa.array([], pa.large_string())


def test_counts_beyond_64_bits(spark):
    big = 3 * 10**18
    rows = [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big), ("en", "a b c", 3, big - 1), ("en", "c", 1, big), ("en", "b c", 2, big)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    got = {r.phrase: (r.score, r.l, r.r) for r in collocations.scored(frame).collect()}
    assert got["a b"] == (1_000_000, big, big) and got["a b c"] == (999_999, big, big)
    assert {r.phrase for r in collocations.absorbed(frame).collect()} == {"a b", "b c"}


def test_no_phrases(spark):
    got = collocations.mine(spark.createDataFrame([], TEXTS))
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations.mine(spark.createDataFrame([(1, None, None, "x", 1, 2)], TEXTS)).count() == 0
