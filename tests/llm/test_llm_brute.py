"""Operators that SQL cannot express, against brute force or held-out truth."""

import hashlib
import io
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from draftledger.llm import catalog, decontaminate, extract, passages, pii, quality, secret_scan, simhash, toxicity, warc

SF = "/root/testdata/sf0.001"


def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_sql_of_the_others(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in catalog.ORACLE_SQL.items():
        got = catalog.QUERIES[name](spark, SF).toPandas()
        want = con.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns), name
        cols = sorted(got.columns)
        key = lambda df: sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None)))
        floats = [c for c in cols if got[c].dtype.kind == "f"]
        got[floats], want[floats] = got[floats].astype(float), want[floats].astype(float)
        assert key(got) == key(want), name


# --- near-duplicates

def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_classes(spark):
    docs = documents(spark)
    got = {r["doc_id"]: r for r in simhash.query(spark, SF).collect()}
    prints = {i: slow_fingerprint(t) for i, t in docs.items()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(docs):
        for j in sorted(docs):
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert {i: r["component_id"] for i, r in got.items()} == {i: find(i) for i in docs}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_pairs(radius):
    r = np.random.default_rng(radius)
    prints = r.integers(0, 2**63, 200, dtype=np.int64).view(np.uint64)
    near = prints[:80] ^ (np.uint64(1) << r.integers(0, 64, 80).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 80).astype(np.uint64))
    prints = np.concatenate([prints, near, prints[:20] ^ np.uint64(0b111), prints[:20] ^ np.uint64(0xF0000000F)])
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= radius}
    assert set(simhash.near_pairs(prints, radius)) == want


def test_links_in_blocks_and_long_chains(spark):
    """Blocks of two lanes give the same classes; a chain longer than any bucket is one class."""
    chain, f = [], 0
    for k in range(40):
        f ^= 3 << (2 * k % 64)
        chain.append(f - (1 << 64) if f >> 63 else f)
    chain = sorted(set(chain))
    df = spark.createDataFrame([(x,) for x in [*chain, 0x7777777777777777]], "fp long")
    for lanes in (2, 4096):
        found = simhash.components(simhash.links(df, 2, lanes)).collect()
        assert {r["node"] for r in found} == set(chain) and len({r["root"] for r in found}) == 1


# --- passages

def slow_removed(docs, length=50):
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in docs:
        b, gone = (t or "").encode(), set()
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone |= set(range(p, p + length))
        out[i] = (len(b), len(gone), sum(p - 1 not in gone for p in gone),
                  hashlib.sha256(bytes(c for p, c in enumerate(b) if p not in gone)).hexdigest())
    return out


def test_passages(spark):
    docs = documents(spark)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in passages.query(spark, SF).collect()}
    assert got == slow_removed(docs.items())


def test_passages_of_few_symbols(spark):
    """Periodic and repetitive texts: keys recur for long, runs are cut, intervals are large."""
    r = random.Random(5)
    docs = [(i, "".join(r.choice(["ab", "abc", "aaaa", "é"]) for _ in range(r.randrange(120)))) for i in range(40)]
    docs += [(100, "a" * 500), (101, "a" * 49), (102, "xx" + "a" * 300), (103, "ab" * 200), (104, "b" + "ab" * 90)]
    got = {x["id"]: x for x in passages.repeated(spark.createDataFrame(docs, "doc_id long, text string"), keep_bytes=False).collect()}
    want = slow_removed(docs)
    for i, x in got.items():
        s = x["spans"]
        assert (x["n_bytes"], sum(b - a for a, b in zip(s[::2], s[1::2])), len(s) // 2, bytes(x["kept"]).hex()) == want[i], i


def test_merged_transforms_and_common_prefixes():
    r = random.Random(2)
    strings = list(dict.fromkeys(bytes(r.choice(b"ab") for _ in range(r.randrange(50, 70))) for _ in range(30)))
    strings += [s[:52] for s in strings[:5]]
    ids = np.array([r.randrange(50) for _ in strings])
    least = {}
    for s, i in zip(strings, ids.tolist()):
        for p in range(len(s) - 49):
            least[s[p:p + 50]] = min(least.get(s[p:p + 50], i), i)
    flat, begin = passages.least_ids(strings, ids)
    for s, a, b in zip(strings, begin, begin[1:]):
        assert flat[a:b].tolist() == [least[s[p:p + 50]] for p in range(len(s) - 49)]
    shards = [strings[i::3] for i in range(3)]
    made = [passages.transform(*passages._symbols(s)) for s in shards]
    turned = []
    for s, (_, string, offset) in zip(shards, made):
        turned += [([c + 1 for c in s[i][p:]] + [0] + [c + 1 for c in s[i][:p]])[:12] for i, p in zip(string, offset)]
    for step in (1, 2, 3, 4):
        row, common = passages.merge([m[0] for m in made], 12, step)
        rows = [turned[i] for i in row]
        assert rows == sorted(rows)
        for a, b, n in zip(rows, rows[1:], common[1:].tolist()):
            alike = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), 12)
            assert n == alike // step * step


# --- decontamination

def test_automaton_against_search():
    r = random.Random(8)
    for window in (2, 3, 4):
        items = [(str(i), [r.choice([b"a", b"b", b"c"]) for _ in range(r.randrange(0, 7))]) for i in range(12)]
        a = decontaminate.Automaton(items, window)
        for _ in range(60):
            doc = [r.choice([b"a", b"b", b"c", b"x"]) for _ in range(r.randrange(0, 25))]
            hit, keys = set(), set()
            for key, words in items:
                n = min(len(words), window)
                for w in {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if words else ():
                    for p in range(len(doc) - n + 1):
                        if tuple(doc[p:p + n]) == w:
                            hit |= set(range(p, p + n))
                            keys.add(key)
            runs, found = a.scan(doc)
            assert {p for x, y in runs for p in range(x, y)} == hit and found == keys


# --- quality

def test_quality_counts():
    r = random.Random(4)
    for _ in range(200):
        text = "".join(r.choice(["a", "b ", " ", "\n", "#", "|", "é", " ", "\t", "ab ab ab ", "\x1c"]) for _ in range(r.randrange(60)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        repeat = {p for i, t in enumerate(triples) if triples.count(t) > 1 for p in range(i, i + 3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        m = quality.measure(text)
        assert m[:5] == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                         sum(x in lines[:i] for i, x in enumerate(lines)), len(repeat))


def test_quality_verdict_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = quality.query(spark, sf).collect()
    good = [r["kept"] for r in got if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in got if labels.get(r["doc_id"]) == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


# --- secrets and personal data

def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)).encode()).hexdigest()


def slow_secrets(text):
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return out + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]


def luhn(number):
    return sum((2 * int(c) - 9 * (c > "4") if i % 2 else int(c)) for i, c in enumerate(reversed(number))) % 10 == 0


def slow_personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]


PARTS = ["password=", "Token: '", "secret", "api_key\"= ", "AKIA", "ABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", " ", ".", "=", "-", "\U0001f600", "é", "x" * 13,
         "a@b.c", "+d@e.f", "1.2.3.4", "300.", "4111 1111 1111 1111", "+1 (555) 555-0100", "9", "(", "\n", "000255.1.2.3"]


def test_base_spans(spark):
    r = random.Random(6)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(14))) for _ in range(400)]
    texts += ["9" * 20_000, "x" * 20_000 + "@", "4 " * 5000, "1." * 5000, "AKIA" * 3000, "password " + " " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for scan, slow in ((secret_scan.scan, slow_secrets), (pii.scan, slow_personal)):
        got = scan(df).select("row.doc_id", "base").collect()
        for x in got:
            assert sorted((s["start"], s["rank"], s["kind"], s["end"]) for s in x["base"]) == sorted(slow(texts[x["doc_id"]])), repr(texts[x["doc_id"]])[:200]


def test_base_digests(spark):
    docs = documents(spark)
    for query, slow in ((secret_scan.query, slow_secrets), (pii.query, slow_personal)):
        for x in query(spark, SF).collect():
            spans = slow(docs[x["doc_id"]])
            assert x["base_sha256"] == digest(spans)
            listed = [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]
            assert set(listed) <= set(x["spans"].split(",")) | {""}


def test_random_tokens_are_found(spark):
    """Random tokens are reported; strings with letters and digits that are not random aren't."""
    r = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = ["".join(r.choice(alphabet) for _ in range(40)) for _ in range(200)]
    plain = ["abc123" * 8 for _ in range(100)] + ["version" + "1" * 40 for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(f"see {x} there" for x in [t for t in secret if not re.search("[0-9a-f]{16}", t)] + plain)), "doc_id long, text string")
    scanned = secret_scan.scan(df)
    got = {x["doc_id"]: x["spans"] for x in secret_scan.found(scanned, secret_scan.limits(scanned)).select("row.doc_id", "spans").collect()}
    n = len(got) - 200
    found = [any(s["kind"] == "random" for s in got[i]) for i in range(len(got))]
    assert sum(found[:n]) >= 0.85 * n and not any(found[n:])


# --- archives, pages, toxicity

def test_records_by_ranges():
    r = random.Random(1)
    inner = b"".join(warc.record_bytes(str(i), None, b"x" * i, "0", None, False) for i in range(3))
    made = [warc.record_bytes(str(i), "http://a/ %\r\n é", bytes(r.randrange(256) for _ in range(r.randrange(300))) + (inner if i % 3 == 0 else b""),
                              "00", "7" if i % 5 == 4 else None, i % 5 == 4) for i in range(20)]
    data, starts = b"".join(made), np.cumsum([0, *map(len, made)])[:-1].tolist()
    for split in (1, 50, 777, 10**6):
        got = [x for at in range(0, len(data), split) for x in warc.records_in(io.BytesIO(data), len(data), at, min(len(data), at + split))]
        assert [at for at, _ in got] == starts
        assert [zlib.decompress(m, 31) for m in made] == [x for _, x in got]
    assert warc.parse(got[4][1])["url"] == "http://a/ %\r\n é"


def test_gradients_of_the_labeller():
    r = np.random.default_rng(0)
    net = extract.Labeller()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, mask = extract._padded([r.random((5, extract.SIZE)).astype(np.float32), r.random((3, extract.SIZE)).astype(np.float32)])
    y = (r.random(mask.shape) > 0.5) * mask

    def loss():
        p = net.forward(x, mask)[0]
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    for k, g in net.gradient(x, mask, y).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept = net.w[k][at]
        net.w[k][at] = kept + 1e-3
        up = loss()
        net.w[k][at] = kept - 1e-3
        down = loss()
        net.w[k][at] = kept
        assert (up - down) / 2e-3 == pytest.approx(float(g[at]), rel=2e-2, abs=1e-5)


def test_extraction_on_pages_not_learned_from(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").toPandas()["html"].tolist()
    net = extract.Labeller(extract.fit(extract.examples(pages[:150])))

    def truth(page):
        body = re.search(r"<article>(.*?)(</article>|<footer)", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", body)
        texts = [" ".join(extract.entities.unescape(re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", p)).split()) for p in parts]
        return "\n\n".join(t for t in texts if t)

    right = 0
    for page in pages[150:]:
        found = extract.blocks(page)
        right += extract.article(found, net.scores([extract.vectors(found)])[0]) == truth(page)
    assert right >= 0.95 * len(pages[150:])


def test_blocks():
    page = "<p>a &amp; b<br>c<p>d <b>e</b> <a href=x>f</a><script>x='</p>'</script> g<!-- open"
    assert [(p, t) for p, t, _ in extract.blocks(page)] == [(("p",), "a & b c"), (("p",), "d e f g")]


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in toxicity.query(spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y, _ in got if not y], [s for s, y, _ in got if y]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc > 0.85 and np.mean([p == y for _, y, p in got]) > 0.92
