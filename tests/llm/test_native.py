"""Quality ledger, secrets, WARC and decontamination on small tables and against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, quality, secrets, warc

DOC = "id long, text string"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# quality ----------------------------------------------------------------------


def measured(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return (
        len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines),
        len(lines) - len(set(lines)), len(hit),
    )


def test_measurements_match_a_plain_count(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a a", "a a a a", "x\x0by z q", "é # *\n\n b\nb \n b", "a b c " * 60, "\n".join(["l m"] * 9)]
    texts += ["".join(rng.choice("ab  \n#é") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    texts.append(" ".join(rng.choice(["u", "v", "w"]) for _ in range(30_000)))
    df = spark.createDataFrame(list(enumerate(texts)), DOC)
    got = {r[0]: tuple(r)[1:] for r in quality.ledger(df).select("id", *[f"ledger.{m}" for m in quality.MEASURES]).collect()}
    for i, text in enumerate(texts):
        n, chars, symbols, lines, dup, rep = measured(text)
        assert got[i] == (n, chars, symbols, lines, dup, rep), text[:50]


def test_policies_and_ablations_read_the_ledger(spark):
    good = " ".join(f"word{i}" for i in range(60))
    texts = [good, good, "short", good.replace(" ", " ### "), " ".join(["a b c"] * 40), None]
    df = spark.createDataFrame(list(enumerate(texts)), DOC).withColumn("_ledger", F.lit(1)).withColumn("n_words", F.lit("x"))
    kept = quality.keep(df)
    assert kept.columns == df.columns and sorted(r[0] for r in rows(kept, "id")) == [0, 1]
    ledgers = quality.ledger(df)
    found = {r["rule"]: (r["failed"], r["regained"]) for r in quality.ablations(ledgers, "web-1").collect()}
    assert found["few_words"] == (2, 2) and found["symbols"] == (1, 1)
    assert found["repeated_windows"][0] == 1
    assert quality.keep(df.limit(0)).count() == 0


# secrets ----------------------------------------------------------------------


def plain_spans(text, reach):
    """Every link by comparing all parts with all parts."""
    strong = secrets.strong_parts(text)
    of = lambda kind: [(s, e) for s, e, k in strong if k == kind]
    near = lambda a, others: any(s <= a[1] + reach and e >= a[0] - reach for s, e in others)
    accounts = [m.span() for m in secrets.ACCOUNT.finditer(text)]
    mixed = lambda t: any(c.islower() for c in t) and any(c.isupper() for c in t) and any(c.isdigit() for c in t)
    keys = [m.span() for m in secrets.KEY40.finditer(text) if mixed(m[0])]
    keys = [k for k in keys if near(k, of("access")) or near(k, accounts)]
    secret = lambda a: near(a, of("assign")) or near(a, keys)
    out = {(s, e, k, False) for s, e, k in strong}
    out |= {(*k, "key40", True) for k in keys}
    out |= {(*a, "account", True) for a in accounts if secret(a)}
    for m in secrets.ENDPOINT.finditer(text):
        if secret(m.span()) and (near(m.span(), of("access")) or near(m.span(), accounts)):
            out.add((*m.span(), "endpoint", True))
    return out


PARTS = [
    "password=abcdefgh1", "AKIA" + "Q" * 16, "0123456789abcdef" * 2, "aB3" * 13 + "x", "https://h.example.org/p",
    "user = bob7", "login: al", "token", "AKIAX", "plain words",
]


@pytest.mark.parametrize("seed", range(6))
def test_links_match_comparing_all_parts(seed):
    rng = random.Random(seed)
    for _ in range(60):
        text = "".join(rng.choice(PARTS) + " " * rng.choice([1, 20, 39, 40, 41, 90]) for _ in range(rng.randrange(12)))
        assert set(secrets.find(text, 40)) == plain_spans(text, 40), text


def test_far_parts_have_no_say():
    pair = "user = bob7 " + "aB3" * 13 + "x"
    alone = {s for s in secrets.find(pair) if s[3]}
    assert {k for _, _, k, _ in alone} == {"key40", "account"}
    with_hex = pair + " " * 6000 + "0123456789abcdef" * 2
    assert {s for s in secrets.find(with_hex) if s[3]} == alone



def test_strong_spans_follow_the_patterns():
    text = 'é PASSWORD = "hunter2hunter" token:short api_key=abc.def/12 AKIAABCDEFGHIJKL0 ' + "0123456789abcdef" * 2 + "g AKIA1 " + "f" * 31
    found = [(text[s:e], k) for s, e, k, linked in secrets.find(text) if not linked]
    assert found == [
        ('PASSWORD = "hunter2hunter', "assign"), ("api_key=abc.def/12", "assign"),
        ("AKIAABCDEFGHIJKL0", "access"), ("0123456789abcdef" * 2, "hex"),
    ]
    assert secrets.find("toKen=abcdefgh1") == []  # the Kelvin sign isn't a letter k


def test_weak_candidates_need_their_complement(spark):
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    site = "https://db.example.org:8443/x"
    alone = f"{key} and {site}"
    linked = f"id AKIAABCDEFGHIJKL then {key} at {site}"
    far = f"id AKIAABCDEFGHIJKL {'x ' * 300}{key}"
    kinds = lambda t: [k for _, _, k, _ in secrets.find(t)]
    assert kinds(alone) == [] and kinds(far) == ["access"]
    assert kinds(linked) == ["access", "key40", "endpoint"]
    both = "user = bob7 and password = hunter2hunter"
    assert kinds(both) == ["account", "assign"]
    df = spark.createDataFrame([(1, linked), (1, linked), (2, None), (3, "")], DOC)
    spans = df.withColumn("s", secrets.secret_spans(F.col("text")))
    got = rows(spans.select("id", secrets.redact(F.col("text"), F.col("s")).alias("t")).orderBy("id"), "t")
    assert got == [("id [access] then [key40] at [endpoint]",)] * 2 + [(None,), ("",)]


def test_links_match_all_pairs_of_intervals():
    rng = random.Random(5)
    for _ in range(300):
        spans, at = [], 0
        for _ in range(rng.randint(0, 6)):
            at += rng.randint(1, 50)
            spans.append((at, at + rng.randint(1, 30)))
            at = spans[-1][1]
        s = rng.randint(0, 200)
        e, reach = s + rng.randint(1, 20), rng.randint(0, 40)
        slow = any(b >= s - reach and a <= e + reach for a, b in spans)
        assert secrets._Near(spans).any(s, e, reach) == slow


# decontamination ----------------------------------------------------------------


def brute(docs, items, window=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for i, text in docs:
        w, hit, ids = cut(text), set(), set()
        for item, body in items:
            v = cut(body)
            n = min(window, len(v))
            for k in range(len(v) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == v[k : k + n]:
                        hit |= set(range(at, at + n))
                        ids.add(str(item))
        out.append((i, len(w), len(hit), ",".join(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_slice", [1, 100_000])
def test_contamination_matches_brute_force(spark, scratch, rows_per_slice):
    rng = random.Random(rows_per_slice)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ünï", "7"]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, words(rng.choice([2, 3, 8, 12, 13, 14, 30]))) for i in range(12)] + [(12, None), (13, ""), (14, "W1 w2"), (14, "W1 w2")]
    docs = []
    for i in range(60):
        parts = [words(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            body = (rng.choice(items)[1] or "").split(" ")
            a = rng.randint(0, len(body) // 2)
            parts += [" , ".join(body[a : a + rng.randint(5, 40)]).upper() if rng.random() < 0.5 else " ".join(body[a:])]
            parts.append(words(rng.randint(0, 5)))
        docs.append((i, "\n".join(parts)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (7, docs[7][1]), (7, "other")]
    got = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        scratch, rows_per_slice=rows_per_slice,
    )
    got = [(r["id"], r["n_words"], r["n_hit"], ",".join(r["item_ids"]), r["contaminated"]) for r in got.collect()]
    assert sorted(got, key=str) == brute(docs, items)


def test_clean_keeps_columns_and_handles_empty_tables(spark, scratch):
    item = " ".join(f"x{i}" for i in range(20))
    docs = spark.createDataFrame(
        [(1, item, "a"), (2, "clean text", "b"), (2, "clean text", "b"), (None, item, "c"), (None, "fine", "d")],
        "doc_id long, text string, h string",
    )
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontaminate.clean(docs, items, scratch)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in rows(kept, "h")) == ["b", "b", "d"]
    assert decontaminate.clean(docs, items.limit(0), scratch).count() == 5
    assert decontaminate.clean(docs.limit(0), items, scratch).count() == 0


# WARC ----------------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archive_round_trip(spark, scratch, compression):
    long, tricky = "é" * 80, "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5
    data = [
        (5, "http://a/\r\nWARC-Type: x", long), (3, "u", long), (9, "v", long), (1, None, "tiny"), (2, "w", "tiny"),
        (7, "x", None), (8, "y", ""), (10, "z", tricky), (3, "u", long), (None, "n", long), (11, "big", "b" * 3_000_000),
    ]
    pages = spark.createDataFrame(data, PAGE).repartition(3)
    path = f"{scratch.root}/w-{compression}"
    warc.write_archive(warc.records(pages, scratch, rows_per_slice=2), path, compression=compression, max_file_bytes=1000)
    back = warc.read_archive(spark, path)
    got = back.select(
        warc.page_of(F.col("record_id")).alias("p"), "record_type", warc.page_of(F.col("refers_to")).alias("r"),
        "payload_digest", "payload_length", "payload", "target_uri",
    ).collect()
    assert len(got) == len(data)
    html = {str(i): h or "" for i, _, h in data if i is not None}
    for r in got:
        full = html.get(r["p"], long).encode()
        assert r["payload_digest"] == "sha256:" + hashlib.sha256(full).hexdigest() and r["payload_length"] == len(full)
        assert bytes(r["payload"]) == (full if r["record_type"] == "response" else b"")
    kinds = Counter((r["p"], r["record_type"], r["r"]) for r in got)
    assert kinds[("3", "response", None)] == 2 or kinds[("3", "response", "")] == 2
    assert kinds[("5", "revisit", "3")] == 1 and kinds[("9", "revisit", "3")] == 1 and kinds[(None, "revisit", "3")] + kinds[("", "revisit", "3")] == 1
    assert sum(n for k, n in kinds.items() if k[1] == "revisit") == 3


def test_pushed_predicates_and_empty_archives(spark, scratch):
    pages = spark.createDataFrame([(i, f"http://h{i % 2}/", "x" * 200 + str(i % 3)) for i in range(9)], PAGE)
    path = f"{scratch.root}/p"
    warc.write_archive(warc.records(pages, scratch), path)
    wanted = warc.read_archive(spark, path, payload="false").where("record_type = 'response' AND target_uri LIKE 'http://h0%'")
    assert sorted(r[0] for r in rows(wanted, "record_id")) == ["<urn:page:0>", "<urn:page:2>"]
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Filter .*response", plan)
    empty = f"{scratch.root}/e"
    warc.write_archive(warc.records(pages.limit(0), scratch), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_reader_steps_over_unwanted_blocks():
    import io

    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            self.taken += n
            return super().read(n)

    row = {"record_type": "response", "record_id": "a", "payload": b"y" * 5000}
    stream = Counting(warc.encode_record(row) + warc.encode_record(row | {"record_id": "b"}))
    got = list(warc.read_records(stream, lambda r: r["record_id"] == "b"))
    assert [bytes(g[-1]) for g in got] == [b"y" * 5000] and stream.taken < 6000
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"junk\r\n"), lambda r: True))
