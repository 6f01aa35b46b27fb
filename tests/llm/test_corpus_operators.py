"""The corpus operators against brute force, with nulls, empty texts, ties and clashing columns."""

import collections
import hashlib
import math
import random
import re
import types
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tablegauge.llm import (
    components,
    context_tree,
    decontaminate,
    html_text,
    line_dedup,
    mixing,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    token_store,
)

SCHEMA = "doc_id long, text string, source string, size long, shard string, fp string, k1 int"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def sample_texts():
    random.seed(3)
    syllables = ["ka", "lo", "mi", "ré", "tun", "sha", "VE", "zu", "Öl"]
    word = lambda: "".join(random.choices(syllables, k=random.randint(1, 3)))
    texts = [" ".join(word() for _ in range(random.randint(1, 60))) for _ in range(40)]
    texts += [texts[0], texts[0], texts[1] + " tail", None, "", " \t\n ", "one", " x y", "a\nb\n\na\n" * 5]
    texts.append(" ".join(random.choices(texts[2].split(), k=3000)))
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "a", "b", "é"][i % 4], 5, "x", "y", 1) for i, t in enumerate(sample_texts())]
    rows += [rows[0], rows[0], (None, "no id here at all", "a", 5, "x", "y", 1), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


# Components


def test_components_follow_links(spark):
    random.seed(1)
    pairs = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3), (7, None)] + [(2000, 2000 + i) for i in range(50)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "x long, y long")).collect()}
    linked = {x for a, b in pairs if None not in (a, b) and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# SimHash


def brute_fingerprint(text):
    words = BLANK.findall(lower(text or ""))
    if not words:
        return 0
    spans = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_equals_brute_force(docs):
    rows = plain(docs)
    fps = {t: brute_fingerprint(t) for _, t in rows}
    roots = classes(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    low = collections.defaultdict(lambda: None)
    for i, t in rows:
        r = roots[fps[t]]
        low[r] = min((x for x in (i, low[r]) if x is not None), default=None)
    want = collections.Counter((i, f"{fps[t]:016x}", low[roots[fps[t]]]) for i, t in rows)
    got = collections.Counter(tuple(r) for r in simhash.near_duplicates(docs).collect())
    assert got == want


def test_close_links_through_overfull_blocks(spark):
    """Many fingerprints around few centres, so blocks go over the limit and are cut again."""
    random.seed(4)
    fps = set()
    for _ in range(3):
        centre = random.getrandbits(64)
        fps |= {centre ^ sum({1 << random.randrange(64) for _ in range(random.randint(0, 4))}) for _ in range(700)}
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    links = simhash.close_links(spark.createDataFrame([(f,) for f in signed], "fp long"), limit=256).collect()
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3 for r in links)
    want = classes(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        x, y = find(r["a"]), find(r["b"])
        parent[max(x, y)] = min(x, y)
    assert {f: find(f) for f in signed} == want


def test_simhash_keeps_one_of_each(docs, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {(r["component_id"], r["fingerprint"]) for r in simhash.near_duplicates(docs).collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len({g for g, _ in groups})
    assert sorted(i for i in ids if i is not None) == sorted({g for g, _ in groups if g is not None})
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


# Quality rules


def brute_counts(text):
    text = text or ""
    words = BLANK.findall(text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {p for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_text_statistics(docs):
    more = ["a b c d e f g h " * 3, "x " * 9, "# * |é| <$%&>\nq\nq\n \n \nq", "w " * 8]
    for text in [t for _, t in plain(docs)] + more:
        assert quality_rules.measure_text(text.encode() if text else None)[:5] == brute_counts(text)


def test_rules_find_planted_thresholds():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    bad = (x[:, 0] > 0.8) | ((x[:, 1] < 0.3) & (x[:, 2] > 0.6))
    rules = quality_rules.learn_rules(x, bad, ["a", "b", "c"])
    verdict = np.zeros(len(x), dtype=bool)
    for rule in rules:
        verdict |= quality_rules._meets(x, ["a", "b", "c"], rule.conditions)
    assert (verdict == bad).mean() > 0.98
    assert quality_rules.learn_rules(x, np.zeros(3000, dtype=bool), ["a", "b", "c"]) == []


def test_quality_verdicts(spark, docs, empty):
    rules = [quality_rules.Rule((("symbols_per_word", False, 0.5),), 1, 0)]
    texts = [" ".join(f"w{i}" for i in range(30)), " ".join(f"#w{i}" for i in range(30)), "short", None]
    frame = spark.createDataFrame([(i, t, "s", 1, "x", "y", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.judge(frame, rules).collect()}
    assert got == {0: (False, True), 1: (False, False), 2: (True, False), 3: (True, False)}
    kept = quality_rules.keep_good(frame, rules)
    assert kept.columns == frame.columns and [r["doc_id"] for r in kept.collect()] == [0]
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 0), (2, None), (1, 1)], "doc_id long, quality int")
    assert quality_rules.fit(frame, labels) == []
    assert quality_rules.fit(empty, labels.limit(0)) == [] and quality_rules.judge(empty, []).count() == 0
    assert quality_rules.judge(docs, []).count() == docs.count()


# Benchmark decontamination


def brute_hits(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[tuple(w[p : p + n])]
        out.append((i, len(w), len(hit), tuple(sorted(map(str, found))), bool(hit)))
    return collections.Counter(out)


def test_contamination_equals_brute_force(spark, docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    long_text = sample_texts()[-1].split()
    items = [
        (1, " ".join(long_text[100:130])),
        (2, " ".join(long_text[500:509])),
        (3, "ONE"),
        (4, ""),
        (5, None),
        (10, " ".join(long_text[100:112]).upper()),
        (11, "ka ka ka ka ka ka ka ka ka ka ka ka"),
        (1, "a b a"),
        (None, "one"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = [(900, "Ka " * 30, "a", 1, "x", "y", 1), (901, "É " + " ".join(long_text[95:118]), "a", 1, "x", "y", 1)]
    all_docs = docs.union(spark.createDataFrame(extra, SCHEMA))
    got = collections.Counter(
        (r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"])
        for r in decontaminate.contamination(all_docs, bench).collect()
    )
    want = brute_hits(rows + [(e[0], e[1]) for e in extra], [i for i in items if i[0] is not None])
    assert got == want
    kept = decontaminate.drop_contaminated(all_docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[4])
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def test_items_without_id_are_hit(spark):
    rows = [(1, "see the quick brown fox"), (2, "lazy dog here"), (3, "a quick brown fox and a lazy dog"), (4, "nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(None, "quick brown"), (None, "BROWN fox"), (7, "lazy dog"), (None, "")], "item_id long, text string")
    got = {r["doc_id"]: tuple(r)[2:] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (3, 1, [], True), 2: (2, 1, ["7"], True), 3: (5, 2, ["7"], True), 4: (0, 0, [], False)}
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()] == [4]


# Mixing


def test_fill_budget_is_exact_where_possible():
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = rng.choice(np.arange(0, 400), size=rng.integers(1, 8), replace=False)
        counts = rng.integers(1, 6, len(sizes))
        reach = {0}
        for s, n in zip(sizes, counts, strict=True):
            reach = {r + s * k for r in reach for k in range(n + 1)}
        budget = int(rng.integers(0, (sizes * counts).sum() + 1))
        take = mixing.fill_budget(sizes, counts, budget)
        got = int((take * sizes).sum())
        assert (take >= 0).all() and (take <= counts).all() and got <= budget
        # The proportional part is fixed first; the rest is as good as its choices allow.
        if len(sizes) == 1:
            assert got == max(r for r in reach if r <= budget)


def brute_targets(sizes):
    names = sorted(sizes, key=lambda n: (n is None, n))
    weight = {n: [5, 2, 1][i % 3] for i, n in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    rest, left = 1.5 * sum(sizes.values()), set(names)
    while rest > 1e-9 and left:
        total = sum(weight[n] for n in left)
        for n in left:
            target[n] += rest * weight[n] / total
        rest = sum(max(0, target[n] - 2 * sizes[n]) for n in left)
        full = {n for n in left if target[n] >= 2 * sizes[n]}
        for n in full:
            target[n] = 2 * sizes[n]
        left -= full
    return target


def test_mix_meets_targets_and_agrees(docs, empty):
    rows = mixing.mix(docs, carry=["doc_id", "source", "text", "size"]).collect()
    names = rows[0].__fields__
    assert names == ["doc_id", "source", "text", "size", "size_", "source_size", "target", "copies"]
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        n = len(BLANK.findall(r["text"] or ""))
        assert r["size_"] == n and 0 <= r["copies"] <= 2
        sizes[r["source"]] += n
        taken[r["source"]] += n * r["copies"]
    target = brute_targets(dict(sizes))
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
    for name, goal in target.items():
        # As near as whole documents allow: one of them is longer than the rest of its source.
        whole = min(int(goal // sizes[name]), 2) if sizes[name] else 0
        reach = {0}
        for r in rows:
            if r["source"] == name:
                reach |= {x + r["size_"] for x in reach}
        best = max(x for x in reach if x <= round(goal - whole * sizes[name]))
        assert taken[name] == whole * sizes[name] + best
    again = mixing.mix(docs.repartition(7), carry=["doc_id", "source", "text", "size"]).collect()
    assert collections.Counter(rows) == collections.Counter(again)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(empty).count() == 0


# Token files


def test_blocks_round_trip():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 511, 512, 513, 70_000):
        ids = (rng.zipf(1.3, n) % 5000).astype(np.uint32)
        tokens, counts = np.unique(np.concatenate([ids, [7]]), return_counts=True)
        table = token_store.FrequencyTable(tokens.astype(np.int64), counts)
        block = token_store.encode_block(ids, table)
        assert (token_store.decode_block(block, table) == ids).all()
        if n == 70_000:
            part = token_store.decode_block(block, table, range(1, 2))
            step = token_store.LANES * token_store.SEGMENT_STEPS
            assert (part == ids[step : 2 * step]).all()
            broken = bytearray(block)
            broken[len(block) // 2] ^= 255
            with pytest.raises(ValueError):
                token_store.decode_block(bytes(broken), table)


def test_wordwise_ids_equal_whole_ids():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    encoder = token_store.WordwiseEncoder(TOKENIZER, kept_words=50, new_words=20)
    cases = [t or "" for t in sample_texts()] + [
        " lead", "trail ", "two  blanks", "it's we'll\n\nnew", "tab\t x", "a b c", "x \ny", "<|endoftext|> z", "emoji 🙂 🙂", "\n", "Ġ Ġx",
    ]
    for text in cases * 2:
        ids = np.frombuffer(encoder.encode(text), dtype=encoder.kind).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text


def test_token_files(docs, empty, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    got = token_store.encode_corpus(docs, TOKENIZER, str(tmp_path / "t"), block_tokens=500).collect()
    rows = plain(docs)
    assert len(got) == len(rows)
    check = lambda t: (lambda ids: (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))(
        whole.encode(t or "", add_special_tokens=False).ids + [0]
    )
    want = collections.Counter((i, *check(t)) for i, t in rows)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got])[:-1])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i))
    assert token_store.encode_corpus(empty, TOKENIZER, str(tmp_path / "e")).count() == 0


# Secrets


def brute_secrets(text):
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token"))
    names += "|[aA][pP][iI]_?[kK][eE][yY]"
    assign = re.compile(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def test_secrets_equal_regular_expressions(spark, empty):
    random.seed(5)
    parts = ["password", "PassWd", "secret", "token", "API_KEY", "apikey", '"', "'", " ", "  ", ":", "=", "AKIA", "abc123",
             "ABCDEFGH12", "deadbeef00", "\n", "x", "é", "/+", "zzzzzz"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(3000)] + [None, "", "日本 " * 40_000 + "a" * 20]
    frame = spark.createDataFrame([(i, t, "s", 1, "x", "y", 1) for i, t in enumerate(texts)], SCHEMA)
    for r in secret_scan.scan(frame).collect():
        want = brute_secrets(texts[r["doc_id"]] or "")
        assert r["base_spans"] == ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(rule == k for _, rule, _, _ in want) for k in range(3))
        assert set(filter(None, r["base_spans"].split(","))) <= set(r["spans"].split(","))
    assert secret_scan.scan(empty).count() == 0


def test_more_rules():
    scanner = secret_scan.Scanner(secret_scan.compile_rules())
    text = b"x -----BEGIN RSA PRIVATE KEY----- y ghp_" + b"A1b2" * 6 + b" xoxb-123456789012-abc"
    kinds = [secret_scan.RULES[k].kind for _, k, _ in scanner.spans(text)]
    assert kinds == ["private_key", "github", "slack"]


def test_minimal_automaton_has_no_equal_states():
    tables = secret_scan.compile_rules()
    again = secret_scan.minimize(tables.all)
    assert len(again.moves) == len(tables.all.moves)


# Shards


def test_shards_are_even_and_gapless(spark, docs, empty):
    many = docs.select("doc_id", "text").unionByName(
        spark.range(3000).select((F.col("id") + 5000).alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.repeat(F.lit("w "), (F.col("id") % 90).cast("int"))).alias("text"))
    )
    rows = sharding.assign(many, shards=8, ranges=64).collect()
    assert len(rows) == many.count()
    source = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in plain(many))
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == source
    bytes_, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        bytes_[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    largest = max(r["size"] for r in rows)
    assert set(slots) == set(range(8)) and max(bytes_.values()) - min(bytes_.values()) <= 2 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.assign(many.repartition(5), shards=8, ranges=64).collect()
    assert collections.Counter(rows) == collections.Counter(again)
    assert sharding.assign(empty).count() == 0
    few = sharding.assign(docs.limit(3), shards=8, ranges=64).collect()
    assert len(few) == 3 and all(r["slot"] == 0 or r["shard"] in [q["shard"] for q in few] for r in few)


# Scores


def test_scores_equal_direct_counts(docs, empty):
    rows = plain(docs)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda t: [w.encode() for w in BLANK.findall(lower(t or ""))] + [b"\n"]
    counts = collections.Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for limit in (1 << 18, 3):
        got = context_tree.score(docs, max_words=limit).collect()
        assert len(got) == len(rows)
        want = collections.Counter(
            (i, held(i), len(tokens(t)), sum(w in counts for w in tokens(t)), n,
             round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6))
            for i, t in rows
        )
        assert want == collections.Counter(
            (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got
        )
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert context_tree.score(empty).count() == 0


def direct_tree(streams, depth):
    """Context-tree weighting of one bit tree at a time, by recursion."""
    seen = collections.defaultdict(lambda: [0, 0])
    for s in streams:
        padded = bytes(depth) + s
        for p in range(depth, len(padded)):
            for j in range(8):
                node = 1 << j | padded[p] >> (8 - j)
                for d in range(depth + 1):
                    seen[padded[p - d : p], node][padded[p] >> (7 - j) & 1] += 1
    children = collections.defaultdict(set)
    for context, node in seen:
        if context:
            children[context[1:], node].add(context)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    weights = {}

    def weighted(context, node):
        own = kt(*seen[context, node])
        if not children[context, node]:
            weights[context, node] = 1.0
            return own
        below = sum(weighted(c, node) for c in children[context, node])
        both = math.log(0.5) + np.logaddexp(own, below)
        weights[context, node] = math.exp(math.log(0.5) + own - both)
        return both

    for node in {n for c, n in seen if not c}:
        weighted(b"", node)

    def one(context, node, d=0):
        at = context[len(context) - d :]
        if (at, node) not in seen:
            return None
        a, b = seen[at, node]
        own = (b + 0.5) / (a + b + 1)
        deeper = one(context, node, d + 1) if d < len(context) else None
        return own if deeper is None else weights[at, node] * own + (1 - weights[at, node]) * deeper

    def log10(s):
        total, padded = 0.0, bytes(depth) + s
        for p in range(depth, len(padded)):
            for j in range(8):
                chance = one(padded[p - depth : p], 1 << j | padded[p] >> (8 - j))
                chance = 0.5 if chance is None else chance
                total += math.log10(chance if padded[p] >> (7 - j) & 1 else 1 - chance)
        return total

    return log10


def test_tree_equals_recursion():
    train = [context_tree.stream(t.encode().lower().split()) for t in sample_texts()[:30] if t]
    depth = 3
    keys, counts = np.unique(context_tree.grams(train, depth)[0], return_counts=True)
    levels = []
    for d in range(depth + 1):
        short, at = np.unique(keys & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        levels.append((short, np.bincount(at, counts).astype(np.int64)))
    tree = context_tree.ContextTree(levels)
    direct = direct_tree(train, depth)
    for text in [train[0], b"shalo kami\n", b"quite new\n", b"\n"]:
        got = tree.log_probabilities(context_tree.grams([text], depth)[0]).sum()
        assert got == pytest.approx(direct(text), rel=1e-5)


def test_rare_runs_keep_their_contexts(docs):
    """However few runs the tasks hold, every text is scored by the tree of all training counts."""
    rows = plain(docs)
    learned = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    streams = [(i, context_tree.stream((t or "").encode().lower().split())) for i, t in rows]
    direct = direct_tree([s for i, s in streams if learned(i)], 5)
    want = sorted((str(i), round(direct(s), 4)) for i, s in streams if len(s) < 2000)
    for cached in (1 << 20, 20):
        got = context_tree.score(docs, cached_runs=cached).collect()
        # Short texts are enough: their rare runs are those a small table lacks.
        short = {str(i) for i, s in streams if len(s) < 2000}
        found = sorted((str(r["doc_id"]), r["score"]) for r in got if str(r["doc_id"]) in short)
        assert [i for i, _ in found] == [i for i, _ in want]
        assert [v for _, v in found] == pytest.approx([v for _, v in want], rel=1e-6, abs=1e-3)


def test_weights_count_all_children(monkeypatch):
    """Groups weighed apart, the smallest ones possible, give the chances of the recursion over all counts."""
    monkeypatch.setattr(context_tree, "WEIGHED_RUNS", 1)
    train = [context_tree.stream(t.encode().lower().split()) for t in sample_texts()[:30] if t]
    texts = [train[0], b"shalo kami\n", b"quite new\n", b"\n"]
    depth, first, mask = 5, 3, (1 << 24) - 1
    keys, n_train = np.unique(context_tree.grams(train, depth)[0], return_counts=True)
    every = np.unique(np.concatenate([keys, context_tree.grams(texts, depth)[0]]))
    every = every[np.argsort(every >> 8 & mask, kind="stable")]
    n = np.zeros(len(every), dtype=np.int64)
    n[np.isin(every, keys)] = n_train[np.searchsorted(keys, every[np.isin(every, keys)])]

    def batches(*columns):
        for i in range(0, len(columns[0]), 7):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 7]) for c in columns], names=[*"abc"][: len(columns)])

    parts = list(context_tree._weigh_deep(depth, first, mask)(batches(every[n > 0], n[n > 0])))
    assert len(parts) > 100
    nodes, at = np.unique(np.concatenate([p.column(0).to_numpy() for p in parts]), return_inverse=True)
    sums = np.bincount(at, np.concatenate([p.column(1).to_numpy() for p in parts]))
    head = context_tree.ContextTree(context_tree.shorter_levels(keys, n_train, 0, first - 1), beyond=(nodes, sums))
    made = list(context_tree._run_logs(types.SimpleNamespace(value=head), depth, first, mask)(batches(every, n, n)))
    logs = {k: v for p in made for k, v in zip(p.column(0).to_pylist(), p.column(2).to_pylist(), strict=True)}
    direct = direct_tree(train, depth)
    for text in texts:
        assert sum(logs[k] for k in context_tree.grams([text], depth)[0].tolist()) == pytest.approx(direct(text), rel=1e-9)
    # A table that looks up the five most frequent runs only answers with these logs, and names the others.
    often = np.array(sorted(logs))[np.argsort([n[every == k][0] for k in sorted(logs)], kind="stable")[-5:]]
    found, missing = context_tree.RunTable(often, np.array([logs[k] for k in often])).find(every)
    assert set(every[missing]) == set(every) - set(often)
    assert all(v == logs[k] for k, v in zip(every, found, strict=True) if k in set(often))


def test_truncated_tree_looks_up_what_bits_give():
    train = [context_tree.stream(t.encode().lower().split()) for t in sample_texts()[:30] if t]
    keys, counts = np.unique(context_tree.grams(train, 3)[0], return_counts=True)
    levels = []
    for d in range(4):
        short, at = np.unique(keys & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        n = np.bincount(at, counts).astype(np.int64)
        often = np.bincount(np.unique(short >> 8, return_inverse=True)[1], n)[np.unique(short >> 8, return_inverse=True)[1]]
        kept = often >= (0, 2, 5, 9)[d]
        levels.append((short[kept], n[kept]))
    tree = context_tree.ContextTree(levels)
    runs = context_tree.grams([*train, b"shalo kami zu\n", b"quite new\n"], 3)[0]
    assert np.allclose(tree.log_probabilities(runs), tree._log_by_bits(runs, 3), atol=1e-5)


def test_chances_add_up_to_one():
    train = [b"abra cadabra\n", b"abracadab\n"]
    keys, counts = np.unique(context_tree.grams(train, 2)[0], return_counts=True)
    levels = []
    for d in range(3):
        short, at = np.unique(keys & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        levels.append((short, np.bincount(at, counts).astype(np.int64)))
    tree = context_tree.ContextTree(levels)
    for context in (b"ab", b"zz", b"\0\0"):
        runs = np.array([context[0] << 16 | context[1] << 8 | b for b in range(256)], dtype=np.int64)
        assert (10 ** tree.log_probabilities(runs)).sum() == pytest.approx(1.0, abs=1e-4)


# Lines


def brute_lines(rows):
    form = lambda line: " ".join(BLANK.findall(lower(line))).encode()
    lines = [(i is None, i, n, k, form(line)) for n, (i, t) in enumerate(rows) for k, line in enumerate((t or "").split("\n"))]
    forms = {x[4] for x in lines if x[4]}
    sets = {f: {f.ljust(5, b"\0")[j : j + 5] for j in range(max(len(f), 5) - 4)} for f in forms}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    roots = classes(forms, alike)
    return lines, roots


def test_lines_equal_brute_force(spark, empty):
    random.seed(8)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda", "theta"]
    base = [" ".join(random.choices(words, k=14)) + str(i) for i in range(12)]
    texts = ["\n".join(random.choice(base) + random.choice(["", "!", "s", " x"]) for _ in range(random.randint(1, 8))) for _ in range(40)]
    texts += [None, "", "\n\n", "abc\nABC\n abc ", texts[0]]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame([(i, t, "s", 1, "x", "y", 1) for i, t in rows], SCHEMA)
    lines, roots = brute_lines(rows)
    seen, want = set(), collections.defaultdict(list)
    for _, i, _, k, form in sorted(lines, key=lambda x: (x[0], x[1], x[2], x[3])):
        if form:
            if roots[form] in seen:
                want[i].append(k)
            seen.add(roots[form])
    got = {r["doc_id"]: (r["n_lines"], list(r["dropped"])) for r in line_dedup.dedup_lines(frame).collect()}
    assert got == {i: ((t or "").count("\n") + 1, want[i]) for i, t in rows}
    assert line_dedup.dedup_lines(empty).count() == 0


def test_lines_are_compared_by_characters(spark):
    """Runs of five characters: of five bytes, lines with longer characters look more alike than they are."""
    french = "élan été forêt près du café où naît à l'île en"
    chinese = "今天天气很好我们一起去公园散步看花然后回家吃饭休息吧你"
    mixed = "Der schöne Fluß fließt über die grünen Wiesen bis zur alten Mühle hinter dem großen Wald 😀"
    pairs = [
        (french, french.replace("café", "cafè")),
        (chinese, chinese[:13] + "山" + chinese[14:]),
        (chinese * 2, chinese * 2 + "山"),
        (mixed, mixed[:-1] + "😁"),
        (mixed, mixed.replace("ü", "u")),
        ("日本", "日"),
    ]
    runs = lambda x: {x[k : k + 5] for k in range(max(1, len(x) - 4))}
    alike = [len(runs(a) & runs(b)) >= 0.8 * len(runs(a) | runs(b)) for a, b in pairs]
    assert alike == [False, False, True, True, False, False]
    for (a, b), want in zip(pairs, alike, strict=True):
        forms = [x.encode() for x in (a, b)]
        numbers, starts = line_dedup.shingles(forms)
        assert [len(set(x.tolist())) for x in np.split(numbers, starts[1:])] == [len(runs(a)), len(runs(b))]
        assert bool(line_dedup._few_links([1, 2], forms)[0]) == bool(line_dedup._indexed_links([1, 2], forms)[0]) == want
    rows = [(i, "\n".join(p)) for i, p in enumerate([*pairs[:2], pairs[3]])]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_dropped"] for r in got} == {0: 0, 1: 0, 2: 1}


def test_lines_of_repeated_rows_and_null_ids(docs):
    rows = line_dedup.dedup_lines(docs).collect()
    assert len(rows) == docs.count()
    copies = [r["n_dropped"] for r in rows if r["doc_id"] == 0]
    assert sorted(copies) == [0, 1, 1]


def test_large_groups_are_compared_in_parts(spark, monkeypatch):
    """With tiny blocks the pairs of blocks still find every link."""
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", 4)
    text = "\n".join("the quick brown fox jumps over the lazy dog while it rains number %02d" % i for i in range(40))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = line_dedup.dedup_lines(frame).first()
    assert (row["n_lines"], row["n_dropped"]) == (40, 39)


def test_text_without_lines(spark):
    frame = spark.createDataFrame([("a\nb\nc", [1]), ("x", [0]), ("x\n", [])], "t string, d array<int>")
    got = [r[0] for r in frame.select(line_dedup.without_lines(F.col("t"), F.col("d"))).collect()]
    assert got == ["a\nc", "", "x\n"]


# Pages

PAGES = {
    "<p>a<p>b": "a\n\nb",
    "<ul><li>x<li>y<ul><li>z</ul></ul>": "* x\n* y\n  * z",
    "<ol start=3><li>x<li value=7>y<li>z</ol>": "3. x\n7. y\n8. z",
    "<table><tr><td>a<td>long cell<tr><td>bbb<td>c</table>": "a   | long cell\nbbb | c",
    "<table><tr><td colspan=2>wide head<tr><td>a<td>b</table>": "wide head\na | b",
    "a<script>no</script><style>x</style><b>b</b> c": "ab c",
    "a<div hidden>no</div><span style='color:red; display : none'>no</span>b": "ab",
    "<pre>  x\n    y</pre>": "  x\n    y",
    "one <b> two </b> three": "one two three",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<h1>T</h1>text<hr>more": "T\n\ntext\n\nmore",
    "&lt;b&gt; &amp; &eacute; &#8364;": "<b> & é €",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<title>no</title><body>yes": "yes",
    "<img src=x alt='a picture'> end": "a picture end",
    "text < 5 & more": "text < 5 & more",
    "</div></p>stray</table>": "stray",
    "": "",
}


@pytest.mark.parametrize("html", list(PAGES))
def test_page_text(html):
    assert html_text.page_text(html) == PAGES[html]


SHOWN = {
    "<p>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></semantics></math>.":
        "so x=2.",
    "a <svg><title>no</title><defs/><metadata>no</metadata><text>left</text><text>right</text><desc>no</desc></svg>b": "a left right b",
    "<desc>x</desc>": "x",
    "a<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>b": "a\nyes\nb",
    "<ol><li style='visibility:hidden'>no<li>y</ol>": "2. y",
    "<table><tr><td style='visibility:hidden'>no<td>b<tr><td>c<td>d</table>": "  | b\nc | d",
    "<table><tr style='visibility:collapse'><td>no<tr><td>c</table>": "c",
    "<i style='visibility:hidden; visibility:visible'>y</i>": "y",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>": "a | b\n  | c\nd | e",
    "<table><tr><td>a<td rowspan=3 colspan=2>bb<td>c<tr><td>d<td>e<tr><td>f</table>":
        "a | bb  | c\nd |     | e\nf |",
    "<table><thead><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>": "a | b\nc | d",
    "<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>": "a | b\n  | c\n  | d",
}


@pytest.mark.parametrize("html", list(SHOWN))
def test_all_that_is_shown(html):
    assert html_text.page_text(html) == SHOWN[html]


def test_pages_without_limits(spark):
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    rows = [(1, deep, "t"), (2, None, "t"), (None, "<p>x", "t"), (3, "w " * 300_000, "t"), (1, deep, "t")]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.extract(frame, keep=()).collect()
    assert collections.Counter((r["page_id"], hashlib.md5(r["text"].encode()).hexdigest()) for r in got) == collections.Counter(
        (i, hashlib.md5(t.encode()).hexdigest())
        for i, t in [(1, "deep"), (2, ""), (None, "x"), (3, ("w " * 300_000).strip()), (1, "deep")]
    )
    assert html_text.extract(frame.limit(0)).count() == 0
