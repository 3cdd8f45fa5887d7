"""Each operator against a brute-force version on small fixtures."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import (components, decontam, fingerprints, language_crf, mixing, ngram_join, sharding,
                           suffix_dedup, token_cache, url_rules, warc)
from gaugeflow.llm.common import exclusive_sums, prepare, table
from gaugeflow.session import staging_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeéstr", k=rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [words(rng, rng.choice([1, 4, 30, 80, 200])) for _ in range(60)]
    base, passage = words(rng, 150), words(rng, 70)
    for _ in range(25):  # near copies
        ws = base.split()
        for _ in range(rng.randint(0, 6)):
            ws[rng.randrange(len(ws))] = "zz" + str(rng.randrange(50))
        texts.append(" ".join(ws))
    for _ in range(20):  # a shared passage in different surroundings
        texts.append(words(rng, 40) + " " + passage + " " + words(rng, 40))
    texts += [texts[3]] * 15 + [None, "", "   ", "é" * 900, "ab" * 400, words(rng, 9000), "12 34"]
    out = [(i * 7, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", "ü", None]), None) for i, t in enumerate(texts)]
    out += [out[2], out[2], out[70]]  # repeated rows
    out.append((None, words(rng, 60), None, None, None))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The rows with extra columns named like the operators' own."""
    prepare(spark)
    df = spark.createDataFrame(rows, DOC).repartition(5)
    return df.select("*", *[F.lit("x").alias(c) for c in ("size", "digest", "shard", "h", "bands", "key", "bin", "cid", "__row", "rank", "found")])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def test_exclusive_sums(spark):
    rng = random.Random(1)
    data = [(k, i, rng.randint(0, 9)) for k in range(3) for i in rng.sample(range(100), 40)]
    got = exclusive_sums(spark.createDataFrame(data, "k int, i long, v long"), ["k"], "i", "v", "before", fan=8).collect()
    assert all(r.before == sum(v for k, i, v in data if k == r.k and i < r.i) for r in got) and len(got) == 120


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 560)] + [(600, 600), (None, 3)]
    group = {}
    for a, b in links:
        if a is not None:
            group.setdefault(a, {a}), group.setdefault(b, {b})
            if group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: min(s) for x, s in group.items()}


@pytest.mark.parametrize("links,batch,most,roots", [
    ([(i % 7, i) for i in range(7, 200)], 9, 5, 7),  # stars round their smallest node
    ([(f"n{i % 7}", f"m{i}") for i in range(200)], 9, 9, 7),  # round their largest
    ([(i, i + 1) for i in range(300)], 200_000, 3, 1),  # a path in order, read by one task
    ([(i, i + 1) for i in range(120)], 1, 50, 1),  # link by link: more rounds
])
def test_components_stage_few_tables(spark, monkeypatch, links, batch, most, roots):
    staged, put = [], components.stage
    monkeypatch.setattr(components, "stage", lambda df, name: staged.append(name) or put(df, name))
    monkeypatch.setattr(components, "TIED_LINKS", batch)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        kind = "string" if isinstance(links[0][0], str) else "long"
        rows = spark.createDataFrame(links, f"a {kind}, b {kind}").coalesce(1)
        got = {r.node: r.root for r in components.components(rows).collect()}
    finally:
        prepare(spark)
    group = {x: x for link in links for x in link}
    for _ in range(len(links)):
        before = dict(group)
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
        if group == before:
            break
    assert got == group and len(set(got.values())) == roots and len(staged) <= most


def brute_repeats(texts, size):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        cover = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - size + 1):
            if seen[d[i:i + size]] > 1:
                cover[i:i + size] = True
        kept = bytes(b for b, c in zip(d, cover) if not c)
        spans = int((cover[:-1] & ~np.append(False, cover[:-2])).sum()) if len(d) else 0
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("size,gram,hot", [(200, 48, 128), (60, 16, 3)])
def test_suffix_dedup(docs, rows, none, monkeypatch, size, gram, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_REGIONS", hot)
    want = Counter((r[0], *b) for r, b in zip(rows, brute_repeats([r[1] for r in rows], size)))
    got = suffix_dedup.remove_repeats(docs, size, gram, with_kept=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert sum(r.n_removed > 0 for r in got) > 30
    if hot == 3:
        assert suffix_dedup.remove_repeats(none).count() == 0


def water_level(caps, weights, total):
    """Share by weight, cap, share the excess anew, until none is above."""
    target, open_, left = [0.0] * len(caps), set(range(len(caps))), total
    while open_:
        sum_w = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / sum_w > caps[i]}
        if not over:
            for i in open_:
                target[i] = left * weights[i] / sum_w
            return target
        for i in over:
            target[i] = caps[i]
        left, open_ = left - sum(caps[i] for i in over), open_ - over
    return target


def test_mix(docs, rows, none, spark):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    by = defaultdict(int)
    for r, n in zip(rows, size):
        by[r[3]] += n
    names = sorted([s for s in by if s is not None]) + [None] * (None in by)
    targets = dict(zip(names, water_level([2.0 * by[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(size))))
    plan = mixing.mix(docs, block_words=8, shard_blocks=50)
    got = mixing.taken_words(plan).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], n) for r, n in zip(rows, size))
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == by[s] and r.target == pytest.approx(targets[s], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in names:
        assert abs(taken[s] - targets[s]) <= max(0.05 * targets[s], 40), s
    again = mixing.taken_words(mixing.mix(docs.repartition(3), block_words=8, shard_blocks=50)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    per_shard = plan.slots.groupBy("shard").count().collect()
    assert len(per_shard) > 10 and all(r["count"] <= 50 for r in per_shard)
    once = plan.slots.groupBy("rank", "epoch", "block").count().filter("count > 1").count()
    assert once == 0
    assert mixing.taken_words(mixing.mix(none)).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    count = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert max(v for k, v in count.items() if k not in (rows[0][0], None)) <= 6 and not mixing.mixed_documents(none).count()


def test_mix_keeps_small_sources_near_their_targets(spark):
    # 40 small sources, of 40 to 79 words in a mix of 60 shards, all but one at their cap of two passes
    data = [(s * 1000 + i, "w " * (10 + (s + 3 * i) % 10), f"s{s:02}") for s in range(40) for i in range(4)]
    data += [(100_000 + i, "w " * 100, "z") for i in range(400)]
    plan = mixing.mix(spark.createDataFrame(data, "doc_id long, text string, source string"), block_words=8, shard_blocks=120)
    source = {i: s for i, _, s in data}
    taken, target = Counter(), {}
    for r in mixing.taken_words(plan).collect():
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - t) <= 8 for s, t in target.items())
    slots = [(r.shard, r.rank, r.turn) for r in plan.slots.collect()]
    sizes = Counter(s for s, _, _ in slots)
    assert len(sizes) > 50 and sorted(sizes) == list(range(len(sizes)))
    assert all(n == 120 for s, n in sizes.items() if s < len(sizes) - 1) and sizes[len(sizes) - 1] <= 120
    turns = defaultdict(list)
    for _, rank, turn in sorted(slots):
        turns[rank].append(turn)
    assert all(t == list(range(len(t))) for t in turns.values())


def test_mix_counts_are_drawn_and_taken_is_what_the_slots_hold(spark):
    prepare(spark)
    data = [(i, "w " * (1 + 37 * i % 90), "abc"[(i > 400) + (i > 560)]) for i in range(600)]
    plan = mixing.mix(spark.createDataFrame(data, "doc_id long, text string, source string"), block_words=4, shard_blocks=64)
    slots = [(r.shard, r.rank, r.block) for r in plan.slots.collect()]
    shards = max(s for s, _, _ in slots)  # the last one may be short
    counts = Counter((s, rank) for s, rank, _ in slots if s < shards)
    totals = Counter(rank for _, rank, _ in slots)
    assert shards > 60 and len(totals) == 3
    for rank, n in totals.items():
        p = n / len(slots)
        spread = 64 * p * (1 - p) * (len(slots) - 64) / (len(slots) - 1)
        mean = [counts[s, rank] for s in range(shards)]
        assert sum((c - 64 * p) ** 2 for c in mean) / shards == pytest.approx(spread, rel=0.45)
        assert sum(mean) / shards == pytest.approx(64 * p, rel=0.1)
    times = Counter((rank, block) for _, rank, block in slots)
    place = {(r.doc_id, r.size): (r.rank, r.offset) for r in plan.rows.collect()}
    got = {r.doc_id: r.taken for r in mixing.taken_words(plan).collect()}
    for (i, size), (rank, offset) in place.items():
        assert got[i] == sum(times[rank, w // 4] for w in range(offset, offset + size))


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("x"))
        got = [r.x for r in df.collect()]
        assert sorted(got) == list(range(n)) and (n < 100 or got != list(range(n)))


def test_fingerprints(docs, rows, none, spark):
    got = fingerprints.fingerprint_documents(docs).collect()
    order = sorted(((r[0] if r[0] is not None else 1 << 62, r[1] or "") for r in rows))
    want = Counter()
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        want[None if i == 1 << 62 else i, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        t = next(x[1] or "" for x in rows if x[0] == r.doc_id)
        assert text.setdefault(t, r.fingerprint) == r.fingerprint
        assert r.near_edited > 0.4 or r.n_chars < 500 or len(set(t)) < 3
    assert len(set(text.values())) == len(text)
    assert fingerprints.fingerprint_documents(none).count() == 0
    one = fingerprints.fingerprint_documents(spark.createDataFrame([(1, "abcd" * 9)], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0


def test_chunks_resist_shifts():
    rng = random.Random(4)
    text = words(rng, 3000)
    data = text.encode()
    ends = fingerprints.chunk_ends(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= fingerprints.MAX_BYTES and (sizes[:-1] >= fingerprints.MIN_BYTES).all()
    assert fingerprints.containment(fingerprints.chunks(text), fingerprints.chunks("inserted words " + text)) > 0.97
    naive = [sum(int(fingerprints._GEAR[data[i - j]]) << j for j in range(32) if i >= j) & 0xFFFFFFFF for i in range(100)]
    assert fingerprints.gear_hashes(data[:100]).tolist() == naive


def test_warc(spark):
    rng = random.Random(5)
    big, small = words(rng, 600), "same"
    pages = [(i, f"http://h{i}.org/a b\r\nX: 1%41", words(rng, 300)) for i in range(40)]
    pages += [(100 + i, "http://copy.org/", big) for i in range(30)] + [(200, "u", small), (201, None, small), (300, "u", None), (301, "u", "")]
    pages += [(129, "again", big), (None, "http://null.org/", big), (-5, "n", "x" * 40000), (400, "c", "a\r\n\r\nWARC/1.1\r\n\r\n" * 90)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    folder = staging_path(spark, "warc-test")
    index = warc.write_archives(df, folder, file_bytes=20000)
    got = warc.read_records(index, folder).collect()
    want = Counter()
    keep = {}
    for i, _, html in pages:
        if i is not None and len((html or "").encode()) >= 1000:
            keep[html] = max(keep.get(html, i), i)
    for i, url, html in pages:
        data = (html or "").encode()
        again = len(data) >= 1000 and i != keep[html]
        want[i, url, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", keep[html] if again else None] += 1
    assert Counter(map(tuple, got)) == want
    chosen = index.filter("page_id in (3, 105)")
    assert sorted(r.page_id for r in warc.read_records(chosen, folder).collect()) == [3, 105]
    assert index.select("file").distinct().count() > 3
    empty = staging_path(spark, "warc-empty")
    assert warc.read_records(warc.write_archives(df.limit(0), empty), empty).count() == 0


def distance_within(pattern, text):
    """Smallest edit distance of the pattern to a substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_decontamination(spark):
    rng = random.Random(6)
    items = [(i, words(rng, rng.choice([8, 25, 40]))) for i in range(8)] + [(90, None), (91, ""), (92, "short"), (3, "a" * 60),
                                                                               (93, "  "), (94, "Two Words"), (95, "c++?")]
    items.append(items[0])

    def edited(text, n):
        chars = list(text)
        for _ in range(n):
            at = rng.randrange(len(chars))
            rng.choice([lambda: chars.pop(at), lambda: chars.insert(at, "q"), lambda: chars.__setitem__(at, "Q")])()
        return "".join(chars)

    docs = [(i, words(rng, 60)) for i in range(20)]
    for k in range(40):
        text = items[k % 8][1]
        docs.append((100 + k, words(rng, 20) + "\n " + edited(text, k // 4).upper() + " " + words(rng, 20)))
    docs += [(500, None), (501, ""), (502, "a" * 500), (503, "shortly two wordsmiths c++?x"),
             (504, "is SHORT"), (505, "(two\n words)"), (506, "in C++? yes"), (507, "ashort"), (100, docs[20][1]), (None, items[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    want = Counter()
    for i, text in docs:
        for item, pattern in {(a, decontam.normalised(b)) for a, b in items if b}:
            if len(pattern) >= decontam.MIN_CHARS:
                k, _ = decontam.pieces(pattern)
                d = distance_within(pattern, decontam.normalised(text))
                if d <= k:
                    want[i, item, d, k] += 1
            elif pattern:  # verbatim, as whole words
                body = f" {decontam.normalised(text)} "
                if any(body.startswith(pattern, a) and not body[a - 1].isalnum() and not body[a + len(pattern)].isalnum()
                       for a in range(1, len(body) - len(pattern))):
                    want[i, item, 0, 0] += 1
    got = decontam.matches(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got if (r.doc_id or 0) > 500 and r.doc_id != 502} == {(504, 92), (505, 94), (506, 95)}
    assert Counter((r.doc_id, r.item_id, r.distance, r.error_budget) for r in got) == want
    assert any(r.distance > 0 for r in got) and not any((r.doc_id or 999) < 20 for r in got)
    clean = decontam.drop_contaminated(df, bench)
    bad = {r.doc_id for r in got}
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, _ in docs if i not in bad)
    assert clean.columns == df.columns
    assert decontam.matches(df.limit(0), bench).count() == 0
    assert decontam.matches(df, bench.limit(0)).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    rng = random.Random(8)
    items = [(i, words(rng, 30)) for i in range(12)]
    docs = spark.createDataFrame([(i, words(rng, 5) + " " + t) for i, t in items], "doc_id long, text string")
    got = decontam.matches(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(12)]


def naive_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def test_url_rules(spark):
    rng = random.Random(9)
    urls = [f"https://{rng.choice(['a', 'b.a', 'spam-farm', 'EXAMPLE', 'x.Example'])}.{rng.choice(['org', 'com', 'example.org', 'net'])}"
            f"{rng.choice(['', '/', '/es/1', '/en/12', '/fr/3', '/de/4', '/de'])}{rng.choice(['', '?q=/es/', '#f'])}" for _ in range(700)]
    urls += [None, "", "nothing", "http://", "x://y://org/", "http://notorg/fr/", "http://org/", "http://É.org/a\nb?c"]
    pages = list(enumerate(urls)) + [(5, urls[5]), (None, "http://q.net/spam")]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("verdict", F.lit("x"))
    bad = {i for i, u in pages if u and "spam-farm" in u and ".net" in u}
    labels = spark.createDataFrame([(i, 0 if i in bad else 1, None) for i in range(0, 700, 2)] + [(None, 0, 1), (7, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = url_rules.judge(df, labels).collect()
    assert Counter((r.page_id, r.host, r.path) for r in got) == Counter((i, *naive_url(u)) for i, u in pages)
    by = {i: u for i, u in pages}
    for r in got:
        fits = [(len(rule), rule, verdict) for verdict, rule in url_rules.RULES
                if (r.host == rule.split("/")[0] or r.host.endswith("." + rule.split("/")[0]))
                and r.path.startswith("/" + rule.split("/", 1)[1])]
        if fits:
            assert (r.rule, r.verdict) == max(fits)[1:]
        else:
            assert r.rule is None
            assert r.verdict == ("block" if r.page_id in bad else "allow"), by[r.page_id]
    assert len(bad) > 5
    assert url_rules.judge(df.limit(0), labels).count() == 0
    assert {r.verdict for r in url_rules.judge(df, labels.limit(0)).filter("rule is null").collect()} == {"allow"}


def test_rules_need_ten_bad_pages_at_any_size(spark):
    rng = random.Random(16)
    urls = [f"https://h{i % 900}.net/{rng.choice('abc')}/{i}?page={i}" for i in range(4000)]
    urls += [f"https://w{i}.spam.net/x" for i in range(12)] + [f"https://h{i}.net/a?cat=pills&page={i}" for i in range(12)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i < 4000), None) for i in range(4012)] + [(4012 + i, 0, None) for i in range(11)],
                                   "doc_id long, quality int, toxic int")
    got = url_rules.judge(df, labels).collect()
    assert sorted(r.page_id for r in got if r.verdict == "block") == list(range(4000, 4024))


def test_rules_with_tokens_of_the_same_pages(spark):
    rng = random.Random(17)
    tokens = []
    for i in range(600):
        t = rng.sample(["t%d" % k for k in range(5)], 3) + ["all"]
        tokens.append((i, t + [x + "'" for x in t if x in ("t1", "t2")] + (["sure"] if i < 15 else [])))
    bad = {i for i, t in tokens if i < 15 or ({"t1", "t3"} <= set(t) and rng.random() < 0.8) or rng.random() < 0.2}
    got = url_rules.mine_rules(spark.createDataFrame(tokens, "page_id long, items array<string>"), spark.createDataFrame(
        [(i, 1, int(i in bad)) for i, _ in tokens], "doc_id long, quality int, toxic int")).collect()
    every = Counter()
    for i, t in tokens:
        for m in range(1, 1 << len(t)):
            key = tuple(sorted(x for k, x in enumerate(t) if m >> k & 1))
            every[key, 0] += 1
            every[key, 1] += i in bad
    strong = {k: every[k, 1] / v for (k, b), v in every.items() if not b and every[k, 1] >= 10 and every[k, 1] / v >= 0.5}
    want = {k: c for k, c in strong.items()
            if not any(strong.get(tuple(x for x in k if x != out), 0) >= c for out in k if len(k) > 1)}
    assert {tuple(r["items"]): r.confidence for r in got} == pytest.approx(want) and len(got) == len(want)
    assert ("sure",) in want and ("t1'", "t3") in want


def test_rules_match_as_brute_force(spark):
    rng = random.Random(10)
    tokens = [(i, rng.sample(["t%d" % k for k in range(6)], 3)) for i in range(400)]
    bad = {i for i, t in tokens if {"t1", "t2"} <= set(t) or ("t3" in t and rng.random() < 0.7)}
    df = spark.createDataFrame(tokens, "page_id long, items array<string>")
    labels = spark.createDataFrame([(i, 1, int(i in bad)) for i, _ in tokens], "doc_id long, quality int, toxic int")
    got = {tuple(sorted(r["items"])): r.confidence for r in url_rules.mine_rules(df, labels, 0.02, 0.6).collect()}
    every = {}
    for i, t in tokens:
        for m in range(1, 8):
            key = tuple(sorted(x for k, x in enumerate(t) if m >> k & 1))
            n, b = every.get(key, (0, 0))
            every[key] = n + 1, b + (i in bad)
    strong = {k: b / n for k, (n, b) in every.items() if b >= 10 and b >= 0.02 * 400 and b / n >= 0.6}
    want = {k: c for k, c in strong.items()
            if not any(strong.get(tuple(x for x in k if x != out), 0) >= c for out in k if len(k) > 1)}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(docs, rows, none, spark, name):
    import public_tokenizers
    path = public_tokenizers.path(name)
    special = [(9001, "a<|endoftext|>b <|endoftext|>", None, None, None), (9002, "<s></s> \x00 x", None, None, None)]
    df = docs.select("doc_id", "text", "digest").unionByName(spark.createDataFrame(special, DOC).select("doc_id", "text", F.lit("x").alias("digest")))
    if name.endswith("json"):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    cache = staging_path(spark, "cache-test")
    want = Counter((r[0], len((r[1] or "").encode()), count(r[1] or ""), count(r[1] or "") > 1024) for r in rows + special)
    assert Counter(map(tuple, token_cache.count_tokens(df, path, cache).collect())) == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({r[1] or "" for r in rows + special})
    more = df.unionByName(spark.createDataFrame([(7777, "something new", "x")], "doc_id long, text string, digest string"))
    assert token_cache.count_tokens(more, path, cache).count() == len(rows) + 3
    assert spark.read.parquet(cache).count() == stored + 1  # only the miss was encoded
    assert token_cache.count_tokens(none, path, cache).count() == 0


def test_crf_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    scores, trans = rng.normal(size=(1, 5, 3)), rng.normal(size=(3, 3))
    total, want = 0, np.zeros((5, 3))
    for path in np.ndindex(*[3] * 5):
        w = np.exp(sum(scores[0, t, y] for t, y in enumerate(path))) * np.mean(np.exp(trans[:, path[0]]))
        w *= np.exp(sum(trans[a, b] for a, b in zip(path, path[1:])))
        total += w
        want[np.arange(5), list(path)] += w
    np.testing.assert_allclose(language_crf.marginals(scores, trans)[0][0], want / total, rtol=1e-9)
    lengths = [1, 64, 65, 300, 2, 128]
    doc = np.repeat(np.arange(6), lengths)
    scores = rng.normal(size=(sum(lengths), 3)) * 2
    shares = language_crf.document_shares(scores, doc, 6, trans)
    for i in range(6):
        np.testing.assert_allclose(shares[i], language_crf.marginals(scores[doc == i][None], trans)[0][0].mean(axis=0), rtol=1e-7)


def test_language(spark, none):
    prepare(spark)
    rng = random.Random(12)
    stock = {"en": "the of and tion ing with that was her on".split(), "de": "der und ung keit die schen nicht ein über zu".split()}

    def text(lang, n):
        return " ".join("".join(rng.choices(stock[lang], k=rng.randint(1, 3))) for _ in range(n))

    data = [(i, text(lang, rng.choice([5, 60, 700])), lang) for i in range(300) for lang in [rng.choice(["en", "de"])]]
    truth = {i: lang for i, _, lang in data}
    data += [(1000, None, "en"), (1001, "12 ...", "de"), (1002, text("de", 40), None), (None, text("en", 40), "en"), (1003, "", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).repartition(3)
    got = language_crf.predict_language(df, language_crf.train(df)).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) and 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    assert np.mean([by[i].lang_pred == lang for i, lang in truth.items() if by[i].held_out]) > 0.97
    assert [by[i].lang_pred for i in (1000, 1001, 1003)] == ["und"] * 3 and by[1002].lang_pred == "de" and by[None].lang_pred == "en"
    model = language_crf.train(df)
    probs = model.tag(language_crf.words_of(text("en", 12) + " " + text("de", 12)))
    assert (probs[2:10, model.langs.index("en")] > 0.5).all() and (probs[14:22, model.langs.index("de")] > 0.5).all()
    kept = language_crf.keep_known(df, model)
    assert kept.columns == df.columns and {i for i, t, _ in data} - {r.doc_id for r in kept.collect()} == {1000, 1001, 1003}
    # labels of held-out documents and of the predicted ones are never used
    swapped = df.withColumn("lang", F.when(language_crf.held_out(F.col("doc_id")), F.lit("de")).otherwise(F.col("lang")))
    assert Counter(map(tuple, language_crf.predict_language(swapped, language_crf.train(swapped)).collect())) == Counter(map(tuple, got))
    empty = language_crf.train(none)
    assert language_crf.predict_language(none, empty).count() == 0
    assert {r.lang_pred for r in language_crf.predict_language(df, empty).collect()} == {"und"}


def test_long_runs_of_letters_are_seen_whole():
    run = "".join(chr(0x4E00 + i * 7 % 900) for i in range(2000))
    for text in (run, run[:25], "x" * 24, "ab " + run + ", cd"):
        parts = language_crf.words_of(text)
        assert "".join(parts) == re.sub(r"\W", "", text) and max(map(len, parts)) <= language_crf.PIECE
    assert language_crf.words_of("x" * 24) == ["x" * 24] and len(language_crf.words_of(run)) == 84
    rng = random.Random(14)
    stock = {"en": "the of and tion ing with that was her on".split(), "zh": [chr(0x4E00 + i) for i in range(60)], "ja": [chr(0x3041 + i) for i in range(60)]}
    line = {lang: lambda n, s=s, gap=" " * (lang == "en"): gap.join(rng.choices(s, k=n)) for lang, s in stock.items()}
    predictor = language_crf.Predictor(language_crf.fit([(line[lang](150), lang) for _ in range(40) for lang in stock]))
    middle = line["ja"](12) + line["zh"](2000) + line["ja"](12)  # the ends alone say ja
    (few, few_score), (inner, _) = predictor.predict(["the and with " + line["zh"](2000), middle])
    assert few == inner == "zh" and few_score > 0.9


def test_unknown_languages_and_noise_go_clean_texts_stay(spark):
    """On the given documents, with texts in other scripts and languages and random letters among them."""
    prepare(spark)
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rng = random.Random(21)
    letters = "abcdefghijklmnopqrstuvwxyz"
    planted = [
        "Однажды в студёную зимнюю пору я из лесу вышел был сильный мороз",
        "今天天气很好我们去公园散步看花然后回家吃饭" * 3,
        "Litwo ojczyzno moja ty jesteś jak zdrowie ile cię trzeba cenić ten tylko się dowie kto cię stracił",
        "Hazádnak rendületlenül légy híve oh magyar bölcsőd az s majdan sírod is mely ápol s eltakar",
        "Kde domov můj voda hučí po lučinách bory šumí po skalinách v sadě skví se jara květ",
        "asdf jkl qwer uiop zxcv asdfgh jklm qwerty uiop zxcvbn asdf lkj poiu mnbv qwop asdl zxcm",
        *(" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(60)) for _ in range(20))]
    rows = [(10 ** 9 + i, t) for i, t in enumerate(planted)]
    extra = spark.createDataFrame(rows, "doc_id long, text string").select(
        *[c if c in ("doc_id", "text") else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
    kept = language_crf.keep_known(docs.unionByName(extra), language_crf.train(docs))
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    lettered = {r.doc_id for r in docs.select("doc_id", "text").collect() if language_crf.words_of(r.text)}
    assert not ids & {i for i, _ in rows}
    assert ids == lettered


def test_more_languages_than_a_byte_counts(monkeypatch):
    monkeypatch.setattr(language_crf, "EPOCHS", 1)
    word = {f"l{k:03}": chr(0x4E00 + 2 * k) * 3 + chr(0x4E01 + 2 * k) for k in range(260)}
    model = language_crf.fit([(" ".join([w] * 4), lang) for lang, w in word.items()])
    assert len(model.langs) == 260 and int(model.lexicon.max()) == 260
    found = language_crf.Predictor(model).predict([w for w in word.values()])
    assert [x for x, _ in found] == list(word)


def test_mixed_texts_are_kept(spark, none, docs):
    prepare(spark)
    rng = random.Random(15)
    stock = {"en": "the of and tion ing with that was her on".split(), "de": "der und ung keit die schen nicht ein über zu".split(),
             "fr": "les des une que pour dans est qui avec sur".split()}

    def text(lang, n):
        return " ".join("".join(rng.choices(stock[lang], k=rng.randint(1, 3))) for _ in range(n))

    model = language_crf.fit([(text(lang, 100), lang) for _ in range(60) for lang in stock])
    mixed = [" ".join(text(lang, 30) for lang in rng.sample(sorted(stock), 3)) for _ in range(40)]
    scores = [score for _, score in language_crf.Predictor(model).predict(mixed)]
    assert min(scores) < 0.35  # no language has a clear share
    data = [(i, t, None, None, None) for i, t in enumerate([*mixed, text("en", 40), "12 ...", "", None])]
    kept = language_crf.keep_known(spark.createDataFrame(data, DOC), model).collect()
    assert sorted(r.doc_id for r in kept) == list(range(41))
    everything = language_crf.keep_known(docs, language_crf.train(docs.withColumn("lang", F.lit(None).cast("string"))))
    assert everything.columns == docs.columns and everything.count() == docs.count()
    assert language_crf.keep_known(none, model).count() == 0


def test_ngram_join(docs, rows, none, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 6)
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, r in enumerate(rows):
        low[find(i)].append(r[0])
    want = Counter((r[0], min((x for x in low[find(i)] if x is not None), default=None), links[i]) for i, r in enumerate(rows))
    got = ngram_join.similarity_classes(docs)
    assert Counter(map(tuple, got.collect())) == want
    kept = ngram_join.one_per_class(docs)
    assert kept.columns == docs.columns
    left = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert left == Counter(k[0] for k in want if k[0] == k[1])
    assert ngram_join.similarity_classes(none).count() == 0 and ngram_join.one_per_class(none).count() == 0
    members = Counter((r.doc_id, r.class_id, r.linked) for r in ngram_join.similarity_members(docs).collect())
    assert members == Counter({(d, c, n > 0): k for (d, c, n), k in _by_linked(want)})
    assert ngram_join.similarity_members(none).count() == 0


def _by_linked(counts):
    merged = Counter()
    for (d, c, n), k in counts.items():
        merged[d, c, min(n, 1)] += k
    return merged.items()


def near_copies(n, length=200, seed=5):
    """Texts that differ from one base in one word each."""
    base = words(random.Random(seed), length).split()
    return [" ".join(base[:i % length] + [f"new{i}"] + base[i % length + 1:]) for i in range(n)]


def texts_sent(monkeypatch, docs):
    """Rows of (doc_id, class_id) and how many texts went to comparisons for them."""
    sent, real = [], ngram_join.stage

    def counted(df, name):
        out = real(df, name)
        if name in ("join-star-assign", "join-assign"):
            sent.append(out.count())
        return out

    with monkeypatch.context() as m:
        m.setattr(ngram_join, "stage", counted)
        found = {(r.doc_id, r.class_id) for r in ngram_join.similarity_members(docs).collect()}
    return found, sum(sent)


def test_members_of_a_large_group_send_texts_in_proportion(spark, monkeypatch):
    prepare(spark)
    figures = []
    for n in (500, 2000):
        docs = spark.createDataFrame(list(enumerate(near_copies(n))), "doc_id long, text string").repartition(4)
        found, sent = texts_sent(monkeypatch, docs)
        assert found == {(i, 0) for i in range(n)}
        figures.append(sent / n)
    assert figures[1] <= 1.5 * figures[0] and figures[1] <= ngram_join.choose_bands()[0] + 2


def test_members_of_chains_far_from_their_centers(spark, monkeypatch):
    """Texts that drift: neighbours are similar, the ends are not, and most are far from any center."""
    prepare(spark)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 5)
    monkeypatch.setattr(ngram_join, "STAR_DOCS", 3)
    rng = random.Random(8)
    data = []
    for chain in range(2):
        text = words(rng, 120).split()
        for i in range(20):
            data.append((1000 * chain + i, " ".join(text)))
            text[(7 * i) % 120] = f"c{chain}w{i}"
            text[(7 * i + 1) % 120] = f"d{chain}w{i}"
    data += [(5000 + i, t) for i, t in enumerate(near_copies(20, seed=9))]
    docs = spark.createDataFrame(data, "doc_id long, text string").coalesce(2)
    got = {tuple(r) for r in ngram_join.similarity_members(docs).collect()}
    assert got == {(d, d // 1000 * 1000, True) for d, _ in data}
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in data[:20])]
    near = [[len(x & y) >= 0.8 * len(x | y) for y in sets] for x in sets]
    assert all(near[i][i + 1] for i in range(19)) and not near[0][19] and sum(near[0]) < 10


def test_choice_of_bands():
    bands, rows = ngram_join.choose_bands(0.8, 0.999, 64)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999 and bands * rows <= 64


def test_similar_pairs():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    got = ngram_join.similar_pairs(sets, 0.5)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            assert got[i, j] == (i != j and 2 * common >= len(a) + len(b) - common)


def brute_capacity(sizes, shards):
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    best = [[10 ** 18 if i and not k else 0 for k in range(shards + 1)] for i in range(len(sizes) + 1)]
    for i in range(1, len(sizes) + 1):
        for k in range(1, shards + 1):
            best[i][k] = min(max(best[j][k - 1], int(prefix[i] - prefix[j])) for j in range(i))
    return min(best[len(sizes)][1:])


def test_minimax_cut():
    rng = np.random.default_rng(3)
    for shards in (1, 3, 7):
        for n in (1, 4, 30):
            sizes = rng.integers(1, 50, n)
            sizes[rng.integers(n)] *= 5
            assert sharding.smallest_capacity(sizes, shards) == brute_capacity(sizes, shards)
            shard = sharding.cut(sizes, shards)
            assert (np.diff(shard) >= 0).all() and shard.max() < shards
            assert np.bincount(shard, sizes).max() == sharding.smallest_capacity(sizes, shards)


def test_sharding(docs, rows, none):
    got = sharding.assign_shards(docs, shards=4)
    assert set(docs.columns) <= set(got.columns)
    got = got.collect()
    assert Counter((r.doc_id, r.text, r["size"], r.text_crc32) for r in got) == Counter(
        (r[0], r[1], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    groups, slots, total = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        groups[r.text or ""].add(r.shard)
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 4
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(none).count() == 0


def test_large_buckets_are_numbered_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BIN", 16)
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"))
    got = sharding.assign_shards(df).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len({r.shard for r in got if r.text == "hot"}) == 1


def test_segments_add_up_to_the_library_count():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, count = Tokenizer.from_file(path), token_cache._counter(path)
    rng = random.Random(13)
    parts = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "\ufeff", "a", "B", "é", "1", "²", "'s", "'", "ll",
             "<|endoftext|>", "<|endof", "text|>", ".", "-", "\x00", "日本", "🙂", "\u0301", "word", "।"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(6000)]
    assert count(texts) == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert not token_cache._splits_at_spaces(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("bits", [None, 1 << 15])
def test_maybe_among_rules_out_only_what_is_not_there(spark, bits):
    from gaugeflow.llm.common import maybe_among

    rows = spark.createDataFrame([(i,) for i in [*range(-50, 5000), None, None]], "id long")
    for ids in ([], [None], [3, 3, -50, 4999, None], list(range(0, 5000, 7))):
        got = maybe_among(rows, "id", spark.createDataFrame([(i,) for i in ids], "x long"), bits).collect()
        assert len(got) == 5052
        assert all(r["__maybe"] for r in got if r["id"] in ids)
        assert sum(not r["__maybe"] for r in got) > 3500


def test_one_per_class_shuffles_no_text_that_has_no_near_copy(spark, monkeypatch):
    """Rows without a near copy reach no exchange, also where the id filter is full."""
    from gaugeflow.llm import ngram_join

    rows = [(i, " ".join(f"w{i}_{j}" for j in range(30)), "s") for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " more", None) for i in range(20)] + [(None, rows[3][1], "n"), (7, rows[7][1], "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    sent = []
    star = ngram_join.maybe_among

    def counted(df, key, ids):
        out = star(df, key, ids)
        sent.append((df.count(), out.filter("__maybe").count()))
        return out

    monkeypatch.setattr(ngram_join, "maybe_among", counted)
    want = sorted(str(tuple(r)) for r in rows[:300] + [rows[320]])
    assert sorted(str(tuple(r)) for r in ngram_join.one_per_class(docs).collect()) == want
    assert len(sent) == 3 and all(some <= 60 < every for every, some in sent)
    monkeypatch.setattr(ngram_join, "maybe_among", lambda df, key, ids: star(df, key, ids, 2))
    assert sorted(str(tuple(r)) for r in ngram_join.one_per_class(docs).collect()) == want
