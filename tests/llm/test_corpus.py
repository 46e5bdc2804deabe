"""The corpus operators against brute force, round trips and held-out labels."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from daybook.llm import decontaminate, exact_dedup, html_text, line_templates, packing, personal_data, repeated_text, set_join, toxicity, warc
from daybook.llm.common import components, hashes_of
from daybook.llm.queries import QUERIES, SQL
from daybook.session import fresh_path

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, id string, score double, `key` int"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 0.5, 1) for i, t in rows], SCHEMA)


def sentence(rng, words, size):
    return " ".join(rng.choice(words) for _ in range(size))


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows, copies and near copies."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = sentence(rng, words, 120)
    near = base.split()
    near[7] = "changed"
    rows = [(1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "   \n"), (7, "one"), (8, "one"), (9, "one two"), (None, "one"), (None, None)]
    rows += [(10, sentence(rng, words, 60_000)), (11, "x" * 70_000), (12, "a@b.c " * 300), (13, "Zeile äöü ñ " + base), (14, base + " tail " + base)]
    rows += [(20 + i, sentence(rng, words, rng.randint(1, 90))) for i in range(60)]
    rows += [(100 + i, " ".join(w if rng.random() > 0.02 else "y" for w in base.split())) for i in range(25)]
    return rows


def sets_of(rows, width):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out.append((i, frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])))
    return out


def brute_components(rows, width, percent):
    sets = sets_of(rows, width)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        common = Counter(j for token in s for j in lists[token])
        for token in s:
            lists[token].append(k)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                parent[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets)), key=str)


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_set_join(spark, odd_rows, width, percent):
    found = set_join.near_duplicates(docs_of(spark, odd_rows), width=width, percent=percent)
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(odd_rows, width, percent)


def test_block_keys_leave_no_pair_out():
    rng = np.random.default_rng(1)
    for _ in range(300):
        percent = int(rng.choice([80, 90]))
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(5, 300), dtype=np.uint64) * np.uint64(2))
        b = a.copy()
        for _ in range(int(rng.integers(0, set_join.difference(len(a), percent) + 1))):
            b = np.delete(b, rng.integers(0, len(b))) if rng.random() < 0.5 and len(b) > 1 else np.unique(np.append(b, rng.integers(0, 1 << 63, dtype=np.uint64)))
        common = len(np.intersect1d(a, b))
        if len(np.setxor1d(a, b)) and 100 * common >= percent * (len(a) + len(b) - common):
            assert len(np.intersect1d(set_join.block_keys(a, percent), set_join.block_keys(b, percent)))


def test_near_dedup_keeps_columns(spark, odd_rows):
    kept = set_join.drop_near_duplicates(docs_of(spark, odd_rows), width=3, percent=90)
    assert kept.columns == ["doc_id", "text", "id", "score", "key"]
    want = {i for i, _, c in brute_components(odd_rows, 3, 90) if i == c}
    assert {r[0] for r in kept.collect()} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 120), (120, 110), (5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 1 for i in range(1, 41)} | {100: 100, 110: 100, 120: 100}


def test_exact_dedup(spark, odd_rows):
    found = exact_dedup.duplicates(docs_of(spark, odd_rows), bucket_rows=4).collect()
    groups = defaultdict(list)
    for i, t in odd_rows:
        groups[t or ""].append(i)
    assert len(found) == len(odd_rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in found:
        ids = by_digest[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}
    rows = exact_dedup.deduplicate(docs_of(spark, odd_rows))
    assert rows.columns == ["doc_id", "text", "id", "score", "key"]
    assert sorted((r.text or "") for r in rows.collect()) == sorted(groups)


def test_directory_splits_overfull_buckets(spark):
    entries = spark.range(3000).selectExpr("xxhash64(id) as key")
    leaves = exact_dedup.directory(entries, 100)
    depth = leaves.first().global_depth
    placed = entries.selectExpr(f"shiftrightunsigned(key, {64 - depth}) as prefix").join(leaves, "prefix")
    assert placed.groupBy("depth", "bucket").count().agg({"count": "max"}).first()[0] <= 100
    assert leaves.agg({"depth": "min"}).first()[0] > 0


def brute_windows(docs, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[k : k + window])].add(str(i))
    out = []
    for i, t in docs:
        w = word.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination(spark, odd_rows, block_bytes):
    texts = [t for _, t in odd_rows if t]
    items = [(1, " ".join(texts[0].split()[5:40])), (2, None), (3, ""), (4, "one two"), (5, "W3, w4"), (6, "none of this occurs"), (7, texts[-1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs_of(spark, odd_rows), benchmark, block_bytes=block_bytes)
    assert sorted(map(tuple, found.collect()), key=str) == brute_windows(odd_rows, items)
    clean = decontaminate.remove_spans(docs_of(spark, odd_rows), benchmark)
    assert clean.columns == ["doc_id", "text", "id", "score", "key"] and clean.count() == len(odd_rows)
    assert not decontaminate.contamination(clean, benchmark).where("contaminated and doc_id < 100").count()
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs_of(spark, odd_rows), empty).where("contaminated").count() == 0


def test_fm_index():
    rng = np.random.default_rng(2)
    for _ in range(40):
        text = np.concatenate([[0], rng.integers(0, 4, rng.integers(1, 80)), [0]])
        order = decontaminate.suffix_array(text)
        assert sorted(order.tolist()) == list(range(len(text)))
        index = decontaminate.FMIndex(text)
        pattern = rng.integers(1, 4, (1, 3))
        low, high = index.search(pattern, np.array([3]))
        want = [k for k in range(len(text) - 2) if (text[k : k + 3] == pattern[0]).all()]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_packing(spark, odd_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(k, t) for k, (_, t) in enumerate(odd_rows)] + [(900, "a<|endoftext|> b　́é\x00 \n\n 12345 ✓\U0001f600")]
    pieces = packing.pack(docs_of(spark, rows), path, length=64, chunk=500).collect()
    tokenizer = Tokenizer.from_file(path)
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    seen, ends = defaultdict(list), defaultdict(int)
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id] and r.doc_tokens == len(want[r.doc_id]) and r.length * 4 == len(r.ids)
        ends[r.sequence_id] += r.length
        seen[r.doc_id].append((r.start, list(np.frombuffer(r.ids, "<u4"))))
    assert {i: [x for _, part in sorted(s) for x in part] for i, s in seen.items()} == want
    assert max(ends.values()) <= 64
    padding = sum(packing.padded_size(n, 64) - n for n in ends.values())
    assert padding < 0.05 * sum(ends.values())


def test_packing_is_optimal():
    rng = random.Random(5)
    for _ in range(60):
        n, length = rng.randint(0, 70), 16
        penalty = np.array([rng.choice([0, 1, 3]) for _ in range(n + 1)], np.int64)
        cost, parent = packing.best_cuts(penalty, length)
        best = [0] + [10**9] * n
        for i in range(1, n + 1):
            for j in range(max(0, i - length), i - length // 2 + 1):
                pad = 0 if (i - j) & (i - j - 1) == 0 else length - i + j
                best[i] = min(best[i], best[j] + pad + int(penalty[i]))
        assert [min(int(c), 10**9) for c in cost] == best


def brute_repeated(rows, length):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[k : k + length] for k in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
        out.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])))
    return sorted(out, key=str)


@pytest.mark.parametrize("many", [repeated_text.MANY, 1])
def test_repeated_text(spark, odd_rows, many):
    rows = [r for r in odd_rows if r[0] not in (10, 11)] + [(700, "ab" * 300), (701, "ñ" * 150), (702, odd_rows[0][1][:199]), (703, "q" + odd_rows[0][1][40:260])]
    found = repeated_text.remove_repeated(docs_of(spark, rows), many=many).collect()
    assert sorted(((*r[:4], bytes(r[4])) for r in found), key=str) == brute_repeated(rows, 200)


def base_spans(text):
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    out = []
    for order, (kind, pattern) in enumerate(kinds):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and total % 10 == 0):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_personal_data(spark, odd_rows):
    rng = random.Random(9)
    signs = list("aZ09.@+-%_ ()\n") + ["\x01", "\x02", "é", "\U0001f600", "a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-9999"]
    rows = odd_rows + [(1000 + k, "".join(rng.choice(signs) for _ in range(rng.randint(0, 60)))) for k in range(600)]
    rows += [(5000, "1 " * 9000 + "4111-1111-1111-1111"), (5001, "a." * 9000 + "x@" + "b." * 9000 + "c"), (5002, "001.0255.3.00000000004 256.1.1.1")]
    found = personal_data.report(docs_of(spark, rows)).collect()
    want = Counter((i, base_spans(t)) for i, t in rows)
    assert Counter((r.doc_id, ",".join(s for s in r.spans.split(",") if s.split(":")[0] in personal_data.KINDS) if r.base_sha256 == hashlib.sha256(w.encode()).hexdigest() else "?")
                   for r, w in zip(sorted(found, key=lambda r: (str(r.doc_id), r.base_sha256)), [w for _, w in sorted(((i, base_spans(t)) for i, t in rows), key=lambda x: (str(x[0]), hashlib.sha256(x[1].encode()).hexdigest()))])) == want


PAGE = "<html><head><title>t</title><script>if (a < b) { x('</p>') }</script></head><body><nav class=m><a href=/>Home</a></nav><header>Site</header><div class='cookie-notice'>We use it</div><article><h1>Head {n} &amp; more</h1><p>First  paragraph <b>{n}</b><br>goes on<p>Second &lt;one&gt; {x}<form>Name <input></form><div class=comments><p>reply {n}</p></div></article><aside>Links</aside><footer>&copy; us</footer>"


def test_html_text(spark):
    rows = [(n, f"https://h.example.org/{n}", PAGE.replace("{n}", str(n)).replace("{x}", "word " * (n % 5))) for n in range(12)]
    want = {n: f"Head {n} & more\n\nFirst paragraph {n} goes on\n\n" + " ".join(["Second <one>", *["word"] * (n % 5)]) for n in range(12)}
    rows += [(50, None, None), (51, None, ""), (52, "x", "<p>a<p>b<!-- c --> d"), (52, "x", "<p>a<p>b<!-- c --> d"), (53, "http://one.example/", "no markup at all <"), (54, "u", "<b" * 2000), (None, "u", "<main><li>i<li>j</main>k")]
    want |= {50: "", 51: "", 52: "a\n\nb d", 53: "no markup at all <", None: "i\n\nj"}
    pages = spark.createDataFrame([(*r, "y") for r in rows], "page_id long, url string, html string, host string")
    found = html_text.extract(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.n_chars == len(r.text)
        if r.page_id != 54:
            assert r.text == want[r.page_id], r


def test_warc_round_trip(spark):
    rows = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://a/4\r\nx: y", ""), (5, "u", "WARC/1.1\r\n\r\n\r\n\r\n"), (5, "u", "WARC/1.1\r\n\r\n\r\n\r\n"), (5, "v", "WARC/1.1\r\n\r\n\r\n\r\n"), (None, "w", "z" * 100_000), (7, "w", "<p>é</p>")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    store, files = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    warc.archive(pages, store)
    original = warc.records(spark, store)
    warc.export(original, files, per_file=2)
    found = warc.read(spark, files).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in found) == Counter(
        (i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) for i, _, h in rows
    )
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in found)
    assert kinds == Counter([(7, "response", None), (1, "revisit", 7), (2, "revisit", 7), (4, "response", None), (3, "revisit", 4), (5, "response", None), (5, "revisit", 5), (5, "revisit", 5), (None, "response", None)])
    assert Counter(bytes(r.header + r.payload) for r in found) == Counter(bytes(r[0]) for r in original.collect())
    assert spark.read.parquet(f"{store}/payloads").count() == 4
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc"))


def brute_lines(rows, depth=3, least=10, share=0.6):
    field = line_templates.masked
    lines = [(i, n, tuple(map(field, x.split()))) for i, t in rows for n, x in enumerate((t or "").split("\n")) if x.split()]
    leaf = lambda w: (len(w), w[:depth])
    reach, support, named, docs = defaultdict(set), defaultdict(set), [], defaultdict(set)
    for i, _, w in lines:
        reach[leaf(w)].add(i)
    lines = [x for x in lines if len(reach[leaf(x[2])]) >= least]
    for i, _, w in lines:
        for k, a in enumerate(w):
            support[leaf(w), k, a].add(i)
    for i, n, w in lines:
        fixed = [a != "<*>" and len(support[leaf(w), k, a]) >= least for k, a in enumerate(w)]
        if sum(fixed) >= share * len(w):
            template = leaf(w), tuple(a if f else "<*>" for a, f in zip(w, fixed))
            named.append((i, n, template))
            docs[template].add(i)
    gone = {(i, n) for i, n, t in named if len(docs[t]) >= least}
    return sorted((i, len(t.split("\n")) if t else 0, sum(j == i for j, _ in gone), "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) if t else t) for i, t in rows)


def test_line_templates(spark):
    rng = random.Random(4)
    rows = [(0, None), (1, ""), (2, "\n\n")]
    for k in range(3, 60):
        own = "\n".join(sentence(rng, ["alpha", "beta", "gamma", "delta"], rng.randint(1, 9)) for _ in range(3))
        rows.append((k, f"User {k} logged in from host{k % 7} at noon\n{own}\nAll rights reserved {rng.choice(['here', 'there', 'now'])}" if k % 2 else own))
    found = line_templates.drop_recurring_lines(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, found)) == brute_lines(rows)


def test_line_templates_shuffle_no_plain_text(spark):
    """Texts travel compressed, whatever they hold, and are the same afterwards."""
    rows = [(k, f"Posted on the web by user {k}\nß 日本 \U0001f600 line\r{k}\x00 " + "own words " * k + "\n") for k in range(30)]
    rows += [(100, None), (101, ""), (102, "own"), rows[0], (None, rows[0][1])]
    zipped = line_templates.zipped(docs_of(spark, rows).select("doc_id", "text")).toArrow()
    assert list(line_templates.unzipped(zipped["zip"].combine_chunks())) == [t for _, t in rows]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = line_templates.drop_recurring_lines(docs_of(spark, rows))
        plan = found._jdf.queryExecution().executedPlan().toString()
        shown = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
        assert sum(r.n_dropped for r in found.collect()) == 32
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan
    moved = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: (.*)", shown)
    assert moved and not any("text#" in columns for columns in moved)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == 1 and r.toxic == 1 for r in found)
    assert right >= 0.9 * sum(r.predicted for r in found) and right >= 0.9 * sum(r.toxic for r in found)
    for r in found[:50]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1


def test_toxicity_without_labels(spark, odd_rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.toxicity(docs_of(spark, odd_rows), none).collect()
    assert len(found) == len(odd_rows) and {(r.score, r.predicted) for r in found} == {(0.0, 0)}


def test_automaton_is_one_edit():
    terms = ["idiot", "scum", "loser", "närrisch"]
    automaton = toxicity.Automaton(terms)
    rng = random.Random(6)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(word) - 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "0", "o", "é"])
        word = "".join(word) or "x"
        points = np.minimum(np.frombuffer(word.encode("utf-32-le"), np.uint32), toxicity.TOP).astype(np.int32)
        found, _ = automaton.matches(points, np.array([0]), np.array([len(points)]))
        near = any(t == word or (len(t) >= toxicity.FUZZY_LENGTH and distance(t, word) <= 1) for t in terms)
        assert bool(len(found)) == near, word


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries(spark, name):
    con = oracle.connect(FOLDER)

    class Checked:
        sql = SQL.get(name)

        def __call__(self, spark, folder):
            return QUERIES[name](spark, folder)

    assert oracle.compare(spark, con, Checked(), FOLDER) == ""


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    import public_tokenizers

    for found in (
        set_join.near_duplicates(docs), set_join.drop_near_duplicates(docs), exact_dedup.duplicates(docs), exact_dedup.deduplicate(docs),
        decontaminate.contamination(docs, benchmark), decontaminate.remove_spans(docs, benchmark), packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")),
        repeated_text.remove_repeated(docs), personal_data.report(docs), line_templates.drop_recurring_lines(docs), toxicity.toxicity(docs, labels), html_text.extract(pages),
    ):
        assert found.count() == 0
    store, files = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    warc.archive(pages, store)
    warc.export(warc.records(spark, store), files)
    assert warc.read(spark, files).count() == 0


def test_pipeline_stages(spark):
    """Each stage against brute force on its own input."""
    import corpus_pipeline as pipeline
    from daybook.llm.common import store

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    steps = dict(pipeline.STAGES)
    assert list(steps) == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "packing"]
    now = store(steps["toxicity"](spark, docs, FOLDER), "t")
    scores = {r.doc_id: r.predicted for r in QUERIES["op3_toxicity"](spark, FOLDER).collect()}
    assert now.columns == columns and {r.doc_id for r in now.collect()} == {i for i, p in scores.items() if not p}
    before = {r.doc_id: r.text for r in now.collect()}
    now = store(steps["exact_dedup"](spark, now, FOLDER), "t")
    best = {}
    for i, t in before.items():
        best[t] = max(best.get(t, i), i)
    assert now.columns == columns and {r.doc_id for r in now.collect()} == set(best.values())
    before = [(r.doc_id, r.text) for r in now.collect()]
    now = store(steps["near_dedup"](spark, now, FOLDER), "t")
    assert now.columns == columns and {r.doc_id for r in now.collect()} == {i for i, _, c in brute_components(before, 5, 80) if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {r.doc_id for r in now.collect()}
    now = store(steps["decontaminate"](spark, now, FOLDER), "t")
    texts = [(r.doc_id, r.text) for r in now.collect()]
    assert now.columns == columns and {i for i, _ in texts} == kept and not any(r[5] for r in brute_windows(texts, items))
    pieces = steps["packing"](spark, now, FOLDER).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r[0] for r in pieces} == kept and all(r[1] == r[2] for r in pieces)


@pytest.mark.parametrize("size", [300, 3000])
def test_line_templates_do_not_depend_on_size(spark, size):
    rng = random.Random(8)
    names, cities = ([f"{kind}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(104)] for kind in ("n", "c"))
    rows = [(k, f"Posted on the web by {rng.choice(names)} in {rng.choice(cities)}\n" + " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(8))) for k in range(size)]
    found = line_templates.drop_recurring_lines(docs_of(spark, rows)).collect()
    assert {(r.n_lines, r.n_dropped) for r in found} == {(2, 1)}
    assert {r.text for r in found} == {t.split("\n")[1] for _, t in rows}


def test_numbers_inside_sentences_are_candidates(spark):
    numbers = ["555-123-4567", "078-05-1120", "(030) 1234567", "+49 30 1234567", "2024/11/05"]
    rows = [(k, f"call {n}{end}") for k, (n, end) in enumerate((n, end) for n in numbers for end in ("", " now", ".", ", ok", ": ok", "/ ok", ") ok", "- ok", "\n"))]
    rows += [(900, "1 " * 9000), (901, "12 is 345."), (902, "(" * 9000 + "1")]
    found = personal_data.prepared(docs_of(spark, rows)).select("key", personal_data.F.filter("candidates", lambda c: c["kind"] == "number")["text"].alias("texts")).collect()
    texts = {r.key: r.texts for r in found}
    assert all(texts[k] == [t[5:].rstrip(" nowk,:/)-.\n")] for k, t in rows[:45])
    assert sum(len(re.sub(r"\D", "", t)) for t in texts[900]) >= 8990 and texts[901] == texts[902] == []


def test_terms_beside_any_sign():
    import pyarrow as pa

    automaton = toxicity.Automaton(["idiot", "scum", "идиот", "मूर्ख", "d'oh"])
    texts = {
        "\u201cidiot\u201d": (0, True, 1), "\u2018scum\u2019 ": (1, True, 1), "\U0001f600idiot\U0001f600": (0, False, 1), "\u2764\ufe0fscum\u2764\ufe0f": (1, False, 1),
        "x\u2014scum\u2014y": (1, False, 3), "idiot\u2026stupid": (0, False, 2), "Ты ИДИОТ!": (2, False, 2), "तुम मूर्ख हो": (3, False, 3), "D\u2019OH": (4, False, 1),
    }
    found = list(toxicity.found_terms(pa.array(list(texts)), automaton))
    for (hits, words), (text, want) in zip(found, texts.items()):
        assert [(int(automaton.exact[s]), q) for s, q, _ in hits] == [want[:2]] and words == want[2], text


@pytest.mark.parametrize("start,end", [
    ("<div class='page has-sidebar'>", "</div>"), ("<div class='post comments-open'><article>", "</article></div>"), ("<section id='search-main'>", "</section>"),
    ("<div class='content share-enabled'><main>", "</main></div>"), ("<div class='widget'><main>", "</main></div>"),
])
def test_wrappers_named_by_a_word_keep_the_article(start, end):
    article = "".join(f"<p>Paragraph {k} of the article, long enough to be one.</p>" for k in range(6))
    page = f"<body><nav>Home</nav>{start}<h1>Head</h1>{article}<div class='related-posts'><p>Other</p></div>{end}<div class='sidebar-left'><p>Links</p></div><div class=comments>{'<p>I say so too, again and again.</p>' * 30}</div></body>"
    small = page.replace("I say so too, again and again.", "No.").replace("<p>No.</p>" * 29, "")
    want = "\n\n".join(["Head", *(f"Paragraph {k} of the article, long enough to be one." for k in range(6))])
    assert html_text.main_text(small, None, set()) == want
    if "main>" in start:
        assert html_text.main_text(page, None, set()) == want


def test_near_copies_on_one_host_keep_their_text(spark):
    shared = [f"Paragraph {k} that all pages of the host have, with words enough." for k in range(5)]
    rows, want = [], {}
    for n in range(24):
        own, kind = f"Updated on day {n}", ("article", "div")[n % 2]
        rows.append((n, f"https://{kind}.example.org/{n}", f"<body><nav>Home</nav><{kind}><p>{own}</p>" + "".join(f"<p>{p}</p>" for p in shared) + f"</{kind}><footer>Us</footer></body>"))
        want[n] = "\n\n".join([own, *shared])
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == want


def test_personal_data_in_texts_full_of_it(spark):
    many = 100_000
    texts = ["ab12345 x " * many, "a@b.c " * many, "+1 (555) 010-9999, " * 30_000, "1.2.3.4 " * many]
    found = {r.doc_id: r for r in personal_data.report(docs_of(spark, enumerate(texts))).collect()}
    assert [found[k].n_email for k in range(4)] == [0, many, 0, 0]
    assert (found[2].n_phone, found[3].n_ip) == (30_000, many)
    for k in (1, 2):
        assert found[k].base_sha256 == hashlib.sha256(base_spans(texts[k]).encode()).hexdigest()


def test_match_positions(spark):
    texts = ["", "x", "MaM", "a\U0001f600MbMMccM\U0001f600\U0001f600MdM", "M1M" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", personal_data.matches(F.split("t", "M", -1)).alias("m"))
    for r in df.collect():
        parts, at, want = r.t.split("M"), 0, []
        for k, part in enumerate(parts):
            at += len(part)
            if k % 2:
                want.append((at - len(part), at, part))
        assert [tuple(x) for x in r.m] == want


@pytest.mark.parametrize("page,text", [
    ("<b" * 1_000_000, None), ("<b" * 1_000_000 + ">x", "x"), ("a > " + "<b" * 500_000, None), ('<a href="x>' * 100_000, ""), ("<script>" + "</script" * 200_000, ""),
    ("<!--" * 200_000, ""), ("<div " + "a" * 1_000_000 + ">t</div>", "t"), ("<p>x<!-- a > b", "x"), ("<p>x</p><!b", "x"), ("t <!-- c --> u <3 v > w <", "t u <3 v > w <"),
    ("<div a='x' class=\"ad\"b=c>d</div>", "d"),
])
def test_unclosed_markup_takes_linear_time(page, text):
    begin = time.monotonic()
    blocks, _ = html_text.blocks_of(page)
    assert time.monotonic() - begin < 5
    assert text is None or " ".join(b.text for b in blocks) == text


def test_long_white_space_is_tokenised():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, _ = packing.encoder(path)
    whole = Tokenizer.from_file(path)
    for text in ("w" + " " * 1_000_000 + "z", "\n" * 1_000_000, "a" * 1_000_000):
        assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(encode(" " * 3_000_000)) == 3_000_000


def test_candidates_apart_from_spans(spark):
    rng = random.Random(3)
    rows = [([("n", a, a + rng.randint(1, 9), "t", "b", "a") for a in rng.sample(range(90), 12)], [(a, a + rng.randint(1, 6)) for a in rng.sample(range(90), n)]) for n in (0, 1, 5, 9)]
    df = spark.createDataFrame(rows, "c array<struct<kind:string,start:int,end:int,text:string,before:string,after:string>>, s array<struct<start:int,end:int>>")
    for r in df.select("c", "s", personal_data.apart(F.col("c"), F.col("s")).alias("left")).collect():
        want = [c for c in r.c if not any(s.start < c.end and c.start < s.end for s in r.s)]
        assert sorted(r.left) == sorted(want)


def thue_morse(letters, size):
    return "".join(letters[bin(k).count("1") % 2] for k in range(size))


@pytest.mark.parametrize("size", [256, 1024, 2048])
def test_words_made_to_collide_stay_apart(spark, size):
    """For any base a polynomial modulo 2^64 takes these words for equal."""
    word, other = thue_morse("ab", size), thue_morse("ba", size)
    start = np.array([0, size])
    hashes = hashes_of(np.frombuffer((word + other).encode(), np.uint8), start, start + size, 7)
    assert hashes[0] != hashes[1]
    rows = [(1, word), (2, other), (3, word)]
    linked = set_join.near_duplicates(docs_of(spark, rows), width=3, percent=90)
    assert sorted(map(tuple, linked.collect())) == brute_components(rows, 3, 90)
    benchmark = spark.createDataFrame([(9, word)], "item_id long, text string")
    found = decontaminate.contamination(docs_of(spark, rows), benchmark)
    assert sorted(map(tuple, found.collect()), key=str) == brute_windows(rows, [(9, word)])
    for many in (repeated_text.MANY, 1):
        kept = repeated_text.remove_repeated(docs_of(spark, rows), many=many).collect()
        assert sorted(((*r[:4], bytes(r[4])) for r in kept), key=str) == brute_repeated(rows, 200)


def test_personal_data_learns_from_all_documents(spark, monkeypatch):
    read = []

    def fitted(rows, precision):
        read.append(rows.count())
        return personal_data.Model([], [], {})

    monkeypatch.setattr(personal_data, "fit", fitted)
    docs = spark.range(50_000).selectExpr("id AS doc_id", "concat('call +4930', 1000000 + id) AS text")
    assert personal_data.report(docs).where("n_phone = 1").count() == 50_000 and read == [50_000]


def test_only_sets_of_possible_pairs_are_built_in_full(spark, monkeypatch):
    common = " ".join(f"c{i}" for i in range(70))
    rows = [(k, common + " " + " ".join(f"u{k}x{i}" for i in range(30))) for k in range(20)]
    rows.append((100, rows[3][1] + " more"))
    full, real = [], set_join.store

    def store(df, name):
        out = real(df, name)
        if "tokens" in out.columns:
            full.append(out.count())
        return out

    monkeypatch.setattr(set_join, "store", store)
    kept = set_join.drop_near_duplicates(docs_of(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(20))
    assert 2 <= sum(full) <= 6
