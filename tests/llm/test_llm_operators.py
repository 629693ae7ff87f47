"""Each operator against a plain version on small, awkward input: nulls, empty
and long texts, ties, repeated rows, empty tables, columns with clashing names."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pitchstar.llm import decontaminate, language_id, line_dedup, minhash_dedup, source_mix, substring_dedup, token_counts, topk_search, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, chunk string, rest string, id string"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    make = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, base = make(40), make(120)
    texts = [None, "", " \n\t ", "one", base, base, base.replace("w1 ", "x1 ", 1), make(60) + " " + passage, passage + "\n" + make(30),
             "a a a a " * 20, "A B c", "a b C", make(3000) + " " + passage, passage]
    texts += ["l1\nl2\nl3\nl4", "x\nl2\nl3\nl4\n\ny", "l2\r\nl3\r\nl4", "q\nq\nq\nq\nq"]
    texts += [make(rnd.randint(1, 80)) for _ in range(25)]
    out = [(i, t, "en", rnd.choice(["s1", "s2", None]), len(t or ""), "c", "r", "i") for i, t in enumerate(texts)]
    return out + [(None, base, None, None, 1, "c", "r", "i"), out[4], out[8]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def key(i):
    return 2**63 - 1 if i is None else i


def repeats(rows, units, window):
    """Removed units by the definition."""
    first = {}
    for i, t in rows:
        u = units(t or "")
        for k in range(len(u) - window + 1):
            w = tuple(u[k:k + window])
            first[w] = min(first.get(w, (key(i), k)), (key(i), k))
    out = []
    for i, t in rows:
        u = units(t or "")
        gone = {j for k in range(len(u) - window + 1) if first[tuple(u[k:k + window])] < (key(i), k) for j in range(k, k + window)}
        out.append((i, len(u), len(gone), [x for j, x in enumerate(u) if j not in gone]))
    return out


def test_substring_dedup(docs, rows, none):
    for window in (3, 20):
        got = substring_dedup.remove_repeats(docs, window=window).collect()
        want = repeats([r[:2] for r in rows], WORD.findall, window)
        assert sorted((key(r.id), r.n_words, r.n_removed, r.kept_text) for r in got) == sorted((key(i), n, k, " ".join(u)) for i, n, k, u in want)
    assert substring_dedup.remove_repeats(none).count() == 0


def test_line_dedup(docs, rows, none):
    lines = re.compile(r"[^\r\n]+").findall
    got = line_dedup.remove_repeated_lines(docs).collect()
    want = repeats([r[:2] for r in rows], lines, 3)
    assert sorted((key(r.id), r.n_lines, r.n_removed, tuple(lines(r.kept_text))) for r in got) == sorted((key(i), n, k, tuple(u)) for i, n, k, u in want)
    kept = line_dedup.keep_rows(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) and kept.where("text is null").count() == 1
    assert line_dedup.keep_rows(none).count() == 0


def test_minhash_dedup(docs, rows, none):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = []
    for r in rows:
        w = WORD.findall(lower(r[1]))
        sets.append((key(r[0]), {tuple(w[k:k + 2]) for k in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set()))
    lowest = {i: i for i, _ in sets}
    for _ in range(len(sets)):
        for i, a in sets:
            for j, b in sets:
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    lowest[i] = lowest[j] = min(lowest[i], lowest[j])
    got = minhash_dedup.near_duplicates(docs, shingle=2).collect()
    assert sorted((key(r.id), r.n_shingles, key(r.component)) for r in got) == sorted((i, len(s), lowest[i]) for i, s in sets)
    assert minhash_dedup.near_duplicates(none).count() == 0


def test_minhash_large_group_of_near_copies(spark):
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for _ in range(90):
        w = list(base)
        for k in rnd.sample(range(150), rnd.randint(0, 14)):
            w[k] = f"n{rnd.random()}"
        texts.append(w)
    sets = [{tuple(w[k:k + 2]) for k in range(149)} for w in texts]
    lowest = list(range(90))
    for _ in range(90):
        for i in range(90):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    lowest[i] = lowest[j] = min(lowest[i], lowest[j])
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.id: r.component for r in minhash_dedup.near_duplicates(df, shingle=2).collect()}
    assert [got[i] for i in range(90)] == lowest


def test_topk_search(spark):
    rng = np.random.default_rng(2)
    v = [(int(i), [float(x) for x in rng.normal(size=6)], 0) for i in range(700)]
    v += [(900 + i, v[0][1], 0) for i in range(60)] + [(2000, None, 0), (2100, [None] * 6, 0), (2200, [float("nan")] * 6, 0), (None, v[1][1], 0), (300, v[5][1], 1), (2300, [], 0)]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>, score int")
    ints = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in e]) for i, e, _ in v if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    want = {}
    for q, a in {(i, tuple(e)) for i, e in ints if i % 100 == 0}:
        want.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b)), j) for j, b in ints if j != q)
    got = {}
    for r in topk_search.top_k(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    for q, found in want.items():
        if q != 300:  # two rows share this id
            assert [x[1:] for x in sorted(got[q])] == sorted(found)[:10]
    assert topk_search.top_k(df.where("false")).count() == 0


def test_source_mix(docs, rows, none):
    d = source_mix.draws(docs).collect()
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    weight = {s: w for s, w in zip(sorted(size, key=lambda s: (s is None, s or "")), (1.0, 2.0, 3.0))}
    total, target, open_ = sum(size.values()), {}, dict(weight)
    rest = float(total)
    while True:
        level = rest / sum(open_.values())
        above = [s for s in open_ if level * open_[s] > 3 * size[s]]
        if not above:
            break
        for s in above:
            target[s] = 3.0 * size[s]
            rest -= target[s]
            del open_[s]
    target |= {s: level * w for s, w in open_.items()}
    assert all(r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 for r in d)
    assert all(0 <= r.copies <= 3 for r in d) and len(d) == len(rows)
    assert sorted((key(r.id), r.size, r.copies) for r in d) == sorted((key(r.id), r.size, r.copies) for r in source_mix.draws(docs.repartition(7)).collect())
    mixed = source_mix.mix(docs, shards=3).collect()
    assert len(mixed) == sum(r.copies for r in d) and {r.shard for r in mixed} <= {0, 1, 2}
    assert source_mix.mix(none).count() == 0


def test_source_mix_walks_on_past_a_huge_document(spark):
    rnd = random.Random(8)
    data = [(0, "x " * 30000, "a")] + [(i, "y " * rnd.randint(60, 120), "a") for i in range(1, 300)]
    data += [(1000 + i, "z " * rnd.randint(60, 120), "b") for i in range(250)] + [(5000, "p " * 90, "b"), (5000, "p " * 90, "b")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    for seed in range(2):
        got = source_mix.draws(docs, seed=seed, weights=(1.0, 3.0)).collect()
        for source in "ab":
            own = [r for r in got if r.source == source]
            target, size = own[0].target, own[0].source_size
            units = {}
            for r in own:
                units.setdefault(r.line, []).append(r)
            gap, drawn = target - target // size * size, set()
            for line in sorted(units):
                w = sum(r.size for r in units[line])
                if w <= gap:
                    gap -= w
                    drawn.add(line)
            near = [(abs(sum(r.size for r in u) - gap), line) for line, u in units.items() if line not in drawn]
            near = [x for x in near if x[0] < gap]
            drawn |= {min(near)[1]} if near else set()
            assert all(r.copies == target // size + (r.line in drawn) for r in own)
            assert abs(sum(r.size * r.copies for r in own) - target) <= 60 < size


def test_warc_rejects_records_inside_payloads(spark, tmp_path):
    evil = "<p>WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n tail\r\n\r\n</p>"
    pages = [(i, f"http://h/{i}", x) for i, x in enumerate(["a" * 50, None, "", evil, "dup", "dup", evil, "é\r\n\r\nx" * 20, "WARC/1.1\r\n", "\r\n\r\n"] + ["z%d" % k * 300 for k in range(20)])]
    pages += [(None, None, "dup"), (4, "http://again", "dup")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    warc.write_archive(warc.records(df), str(tmp_path / "w"))
    first = {}
    for i, _, h in pages:
        first[h or ""] = min(first.get(h or "", key(i)), key(i))
    for split in ("128m", "700b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            got = warc.read_archive(spark, str(tmp_path / "w")).collect()
            light = warc.read_archive(spark, str(tmp_path / "w"), payloads=False).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted((r.id, r.payload) for r in got if r.record_type == "response") == sorted((i, h or "") for i, _, h in pages if key(i) == first[h or ""])
        assert sorted((key(r.id), r.refers_to) for r in light if r.record_type == "revisit") == sorted((key(i), first[h or ""]) for i, _, h in pages if key(i) != first[h or ""])
        assert sorted(r.sha1 for r in light if r.sha1) == sorted(hashlib.sha1((h or "").encode()).hexdigest() for i, _, h in pages if key(i) == first[h or ""])


def test_token_counts_follow_edits(rows):
    encode = token_counts.encoder(token_counts.VOCABULARY).encode_ordinary
    count = lambda t: len(encode(t))
    rnd = random.Random(1)
    for _ in range(400):
        t = (rnd.choice(rows)[1] or "")[:2000]
        cuts = token_counts.cuts_of(t, rnd.choice([8, 64, 512]))
        sums = token_counts.tree_of([count(t[a:b]) for a, b in zip(cuts, [*cuts[1:], len(t)])])
        edits = []
        for _ in range(rnd.randint(0, 4)):
            a = rnd.choice([rnd.randint(0, len(t)), (rnd.choice(cuts) if cuts else 0) + rnd.randint(-2, 2)])
            edits.append({"start": a, "end": a + rnd.choice([0, 1, 2, 30, 700]), "text": rnd.choice(["", " ", "x", "  y", "'s", "12 ", None])})
        edits = token_counts.accepted(edits, len(t))
        assert token_counts.update(t, cuts, sums, edits, count)[0][1] == count(token_counts.edited(t, edits))


def test_token_counts_tables(docs, none):
    for df, n in ((docs, docs.count()), (none, 0)):
        trees = token_counts.build(df)
        edited = trees.selectExpr("*", "cast(null as array<struct<start:int,end:int,text:string>>) as edits")
        got = token_counts.apply_edits(edited).collect()
        assert len(got) == n and all(r.n_before == r.n_after for r in got)


def test_decontaminate(spark, docs, rows, none):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, "Two words"), (None, "nothing of this occurs anywhere here")], "item_id long, text string")
    more = [(500, "pad " * 50 + "Alpha, beta; gamma DELTA epsilon zeta eta theta iota kappa. " + "pad " * 50), (501, "alpha beta gamma delta new zeta eta theta iota kappa"), (502, "alpha beta gamma only"), (503, "x two words y"), (504, None)]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {(r.id, r.item_id): r.score for r in decontaminate.contaminated(d, items).collect()}
    assert set(got) == {(500, 1), (501, 1), (503, 3)} and got[500, 1] == 1.0 and got[501, 1] < 1.0
    assert decontaminate.clean_rows(d, items).count() == d.count() - 3
    assert decontaminate.clean_rows(docs, items.where("false")).count() == len(rows) and decontaminate.contaminated(none, items).count() == 0


def test_decontaminate_finds_every_edited_copy(spark):
    rnd = random.Random(12)
    common, rare = [f"c{i}" for i in range(40)], [f"r{i}" for i in range(4000)]
    make = lambda n: [rnd.choice(common if rnd.random() < 0.5 else rare) for _ in range(n)]
    items = [make(rnd.randint(20, 60)) for _ in range(40)]
    texts = [make(rnd.randint(0, 150)) for _ in range(60)]
    for k, item in enumerate(items):  # one word in ten to one in three replaced; words put in; the common ones only
        for part in (0.1, 0.2, 0.3):
            w = list(item)
            for j in rnd.sample(range(len(w)), int(part * len(w))):
                w[j] = f"new{rnd.getrandbits(40)}"
            texts.append(make(rnd.randint(0, 90)) + w + make(rnd.randint(0, 90)))
        texts += [[x if j % 3 else f"new{j}" for j, x in enumerate(item)], [y for j, x in enumerate(item) for y in (x, f"in{j}")],
                  item[:len(item) // 2] + make(rnd.randint(5, 25)) + item[len(item) // 2:], [x for x in item if x in common]]
    want = {}
    for i, t in enumerate(texts):
        for k, item in enumerate(items):
            if t and (s := decontaminate.align(np.array([hash(x) for x in item], np.int64), np.array([hash(x) for x in t], np.int64))[0] / len(item)) >= 0.5:
                want[i, k] = s
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    table = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    got = {(r.id, r.item_id): r.score for r in decontaminate.contaminated(docs, table).collect()}
    assert set(got) == set(want) and len(want) > 200 and all(abs(got[x] - want[x]) < 1e-9 for x in want)
    assert decontaminate.clean_rows(docs, table).count() == len(texts) - len({i for i, _ in want})


def test_decontaminate_lowers_every_alphabet(spark):
    docs = spark.createDataFrame([(1, "ÑANDÚ ÓLEO ÉPOCA ΑΒΓ ЖУК"), (2, "ñandú óleo"), (3, "ñandu oleo epoca")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "ñandú óleo época αβγ жук")], "item_id long, text string")
    assert [(r.id, r.score) for r in decontaminate.contaminated(docs, items).collect()] == [(1, 1.0)]


def test_smith_waterman_against_the_full_matrix():
    rnd = random.Random(9)
    for _ in range(60):
        a, b = (np.array([rnd.randint(0, 3) for _ in range(rnd.randint(1, 12))], np.uint64) for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1))
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (decontaminate.MATCH if a[i] == b[j] else decontaminate.MISMATCH), h[i, j + 1] + decontaminate.GAP, h[i + 1, j] + decontaminate.GAP)
        assert abs(decontaminate.align(a, b)[0] - h.max()) < 1e-9


def test_language_id(spark, none):
    en, de = "the cat and the dog with this house and that thing of the town ", "der hund und die katze mit dem haus und das ding der stadt "
    html = lambda lang, body: f'<html lang="{lang}"><body><p>{body}</p></body></html>'
    pages = [(i, "http://a.example.com/x", html("en", en * 3)) for i in range(12)] + [(100 + i, "http://b.example.de/x", html("de-AT", de * 3)) for i in range(12)]
    pages += [(200, "http://b.example.de/y", html("en", de * 2)), (201, None, None), (202, "", ""), (203, "not an address", "12345 !!"), (100, "http://b.example.de/x", html("de", de))]
    got = {r.key: r.language for r in language_id.identify(language_id.pages_evidence(spark.createDataFrame(pages, "page_id long, url string, html string"))).collect()}
    assert {got[i] for i in range(12)} == {"en"} and {got[100 + i] for i in range(12)} == {"de"} and got[200] == "de"
    assert got[201] == got[202] == got[203] == "und"
    assert language_id.keep_identified(none).count() == 0


def test_toxicity(spark):
    rnd = random.Random(4)
    words = [f"{a}{b}{c}" for a in ("tel", "mon", "sar", "pil") for b in ("ade", "oru", "imi") for c in ("s", "nt", "k", "ra")]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    data, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        data.append((i, f"{text(12)}. {text(5)} {rnd.choice(['grumblok', 'zwerpig']) if bad else ''} {text(5)}.\n{text(6)}"))
        labels.append((i, 1, int(bad)))
    data += [(1000, None), (1001, ""), (1002, text(20) + " grum-b-lok " + text(5)), (1003, text(10) + " z w e r p i g "), (1004, text(30)), (1005, text(5) + " grumbxlok")]
    docs = spark.createDataFrame(data, "id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in labels)
    assert min(got[1002], got[1003]) >= 0.5 and max(got[1000], got[1001], got[1004]) < 0.5 and got[1005] > 2 * got[1004]
    bare = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r.score for r in toxicity.score(docs, bare).collect()} == {0.5}


def test_string_kernel_against_its_definition():
    from itertools import combinations

    def plain(a, b):
        weight = lambda w: {}
        del weight
        total = 0.0
        for i in combinations(range(len(a)), toxicity.ORDER):
            for j in combinations(range(len(b)), toxicity.ORDER):
                if all(a[x] == b[y] for x, y in zip(i, j)):
                    total += toxicity.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
        return total
    for a, b in ((b"moron", b"moron"), (b"mo-ron", b"moron"), (b"abcabc", b"abc"), (b"xyz", b"abc")):
        assert abs(toxicity.kernel(toxicity.padded([a]), toxicity.padded([b]))[0] - plain(a, b)) < 1e-9


def test_text_buffers_of_slices():
    from pitchstar.llm.common import Words, text_buffers
    a = pa.array(["x y", None, "", "z"]).slice(1, 3)
    w = Words(*text_buffers(a))
    assert [w.at(i) for i in range(len(w.start))] == [b"z"] and list(np.diff(w.first)) == [0, 0, 1]
