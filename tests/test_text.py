from __future__ import annotations

import random
import unicodedata
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import markup, pii, repetition, text, unicode
from corpusloom.operators import stages


def column(spark, values, expression, *, schema="text string"):
    df = spark.createDataFrame([(v,) for v in values], schema).coalesce(1)
    return [r[0] for r in df.select(expression(F.col("text"))).collect()]


def test_strip_removes_all_unicode_space(spark):
    assert column(spark, ["\u3000 a b \u00a0\n", "", None], text.strip) == ["a b", "", None]


def test_word_count_edges(spark):
    assert column(spark, ["", " \n", "one", "a\tb\r\nc", None], text.word_count) == [0, 0, 1, 3, 0]


def test_bucket_is_in_range_and_stable(spark):
    got = column(spark, ["a", "b", "a"], lambda c: text.bucket(c, 7))
    assert got[0] == got[2] and all(0 <= b < 7 for b in got)


@pytest.mark.parametrize("words, kept", [(49, False), (50, True), (51, True)])
def test_word_limit(spark, words, kept):
    df = spark.createDataFrame([(" ".join(["w"] * words),)], "text string")
    out = df.transform(stages.score_filter(stages.WordCount(50), score_field="word_count"))
    assert [r.word_count for r in out.collect()] == ([words] if kept else [])
    dropped = df.transform(stages.score_filter(stages.WordCount(50)))
    assert dropped.columns == ["text"]


def test_top_ngrams(spark):
    values = ["a b a b cc dd cc dd", "one", "", None]
    got = column(spark, values, lambda c: repetition.top_ngrams(c, [2, 3]))
    # "a b" and "cc dd" both come twice: the longer one wins.
    assert [tuple(t) for t in got[0]] == [(2, 2, 5), (3, 1, 8)]
    assert [tuple(t) for t in got[1]] == [(2, 0, 0), (3, 0, 0)]
    assert got[2] == got[3] == got[1]


def test_top_ngrams_by_character(spark):
    got = column(spark, ["中文 中文"], lambda c: repetition.top_ngrams(c, [2], "zh"))
    assert tuple(got[0][0]) == (2, 2, 2)


def test_repetition_limit_is_inclusive(spark):
    # The bigram "ab" + blank + "c" is 4 of 20 characters: exactly 20 %.
    at_limit = "ab c defghi jklm nop"
    assert len(at_limit) == 20
    df = spark.createDataFrame([(at_limit,)], "text string")
    longest = df.select(repetition.top_ngrams(F.col("text"), [2])).first()[0][0]
    percent = longest["count"] * longest["length"] * 100 // 20
    keep = lambda p: df.transform(stages.score_filter(stages.RepeatingNgrams(((2, p),)))).count()
    assert keep(percent) == 1 and keep(percent - 1) == 0


PERSONAL = "Mail a.b@c.example.org or 10.0.0.1, +1 (555) 123-4567, card 4111 1111 1111 1111."


def test_pii_actions(spark):
    run = lambda action, **kw: column(spark, [PERSONAL], lambda c: pii.anonymize(c, action, **kw))[0]
    assert run("replace") == (
        "Mail <EMAIL_ADDRESS> or <IP_ADDRESS>, <PHONE_NUMBER>, card 4111 1111 1111 1111."
    )
    assert run("redact") == "Mail  or , , card 4111 1111 1111 1111."
    assert run("mask").startswith("Mail " + "*" * 17 + " or " + "*" * 8 + ", " + "*" * 17)
    assert "10.0.0.1" not in run("hash") and len(run("hash")) > len(PERSONAL)
    assert run("replace", entities=["IP_ADDRESS"]).startswith("Mail a.b@c.example.org or <IP_ADDRESS>")
    assert "<CARD>" in run("replace", patterns={"CARD": r"\d{4}( \d{4}){3}"})
    with pytest.raises(ValueError):
        pii.anonymize(F.lit("x"), entities=["PERSON"])
    with pytest.raises(ValueError):
        pii.anonymize(F.lit("x"), "encrypt")


def test_mask_changes_only_the_match(spark):
    # "1.2.3.4" also lies inside the longer number, which is no address by itself.
    got = column(spark, ["1.2.3.4 v1.2.3.4x"], lambda c: pii.anonymize(c, "mask"))
    assert got == ["******* v1.2.3.4x"]


def test_encrypt_can_be_undone_and_hides_the_key(spark):
    secret = "0123456789abcdef"
    key = spark.createDataFrame([(secret,)], "key string").scalar()
    df = spark.createDataFrame([(PERSONAL,), (None,), ("nothing here",)], "text string").coalesce(1)
    out = df.transform(stages.pii_stage(action="encrypt", key=key, entities=["EMAIL_ADDRESS"]))
    plan = out._jdf.queryExecution().toString()
    assert secret not in plan
    rows = [r[0] for r in out.collect()]
    cipher = rows[0].split("Mail ")[1].split(" or ")[0]
    back = spark.range(1).select(F.aes_decrypt(F.unbase64(F.lit(cipher)), F.lit(secret)).cast("string"))
    assert back.first()[0] == "a.b@c.example.org"
    assert rows[1:] == [None, "nothing here"]


def repaired(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "text string").coalesce(1)
    return [r.text for r in unicode.repair(df).collect()]


def test_unicode_repair(spark):
    broken = "é".encode().decode("latin-1")
    values = [broken, "e\u0301", "a\x00b\x85c\td", "a\r\nb\rc", "plain", "naïve", "Ω日本", None]
    assert repaired(spark, values) == [
        "é", "\u00e9", "ab…c\td", "a\nb\nc", "plain", "naïve", "Ω日本", None,
    ]


def test_cards_are_checked_and_further_entities_asked_for(spark):
    texts = ["4111 1111 1111 1111 x", "4111 1111 1111 1112", "378282246310005", "123-45-6789", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    change = lambda **o: [r[0] for r in df.select(pii.anonymize(F.col("t"), **o)).collect()]
    named = list(pii.MORE_PATTERNS)
    assert change(entities=named) == ["<CREDIT_CARD> x", texts[1], "<CREDIT_CARD>", "<US_SSN>", "<CRYPTO>"]
    assert change(entities=["CREDIT_CARD"], action="mask")[0] == "*" * 19 + " x"
    assert change() == texts
    assert change(patterns={"X": "x$"})[0] == "4111 1111 1111 1111 <X>"


SOUND = ["itâ€ is", "“CAFÉ” «À» É»", "allé…»", "naïve “É”", "Ã", "São Paulo", "MAÇÃ”", "Ω日本", "à «non»", ""]
BROKEN = ["it’s café", "été", "Österreich", "sûr", "“quoted” – dash…", "日本語のテキスト", "Привет, мир", "naïve NBSP\xa0x", "😀 ok"]


@pytest.mark.parametrize("times", [1, 2, 3])
def test_mojibake_is_read_again_run_by_run(spark, times):
    def windows(text):
        read = text.encode().decode("latin-1")
        named = [unicode.WINDOWS_1252[ord(c) - 0x80] if 0x80 <= ord(c) < 0xA0 else c for c in read]
        return "".join(c if n == " " and c != " " else n for c, n in zip(read, named, strict=True))

    for damage in (windows, lambda text: text.encode().decode("latin-1")):
        damaged = BROKEN
        for _ in range(times):
            damaged = [damage(t) for t in damaged]
        assert repaired(spark, damaged) == BROKEN
        # The sound part of a text stays as it is.
        assert repaired(spark, [t + " — né «à» 日本" for t in damaged]) == [t + " — né «à» 日本" for t in BROKEN]


def test_sound_texts_are_left_alone(spark):
    assert repaired(spark, SOUND) == SOUND
    long = "É» à «" * 200_000
    assert unicode.repair_mojibake(long) == long


def test_characters_taken_as_composed_are_stable():
    import re

    safe = re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\U{m[1]:0>8}", unicode.COMPOSED) + "]")
    chars = [chr(p) for p in range(0x110000) if safe.match(chr(p))]
    assert all(unicodedata.is_normalized("NFC", c) for c in chars)
    assert not any(unicodedata.combining(c) for c in chars)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=20))
def test_repair_gives_nfc_without_controls(spark, values):
    values = [v.replace("\x00", "") for v in values]
    for got in repaired(spark, values):
        assert unicodedata.is_normalized("NFC", got)
        assert not any(unicodedata.category(c) == "Cc" and c not in "\t\n" for c in got)


def test_wiki_text(spark):
    source = (
        "{{Box|{{in|{{ner}}}}}}'''Bold''' [[a|b]] [[c]] [http://x.org/y z]<ref>r</ref>"
        "<ref name=q/> {| t |} [[File:f.png|thumb|see [[c]]]]<!-- n -->"
    )
    assert column(spark, [source], markup.wiki_text) == ["Bold b c z"]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("{{a|{{b|{{c|{{d|{{e|{{f|}}}}}}}}}}}}x", "x"),
        ("{{{1|d}}} {{a|{{{2|}}}}} y", "y"),
        ("a {{open [[b|c]] d", "a {{open c d"),
        ("a }} ]] |} b", "a }} ]] |} b"),
        ("{{a [[b}} c]]", "c]]"),
        ("{|\n| {|\n| x\n|}\n| y {{z|}}\n|}\nafter", "after"),
        ("[[Image:x.png|[[File:y|z]] w]]v", "v"),
        ("[[a|b|c]] [[ d ]] [[:File:e]]", "b|c d File:e"),
        ("=== H ===\nt == u\n__TOC__\n; d : e", "H\nt == u\n\nd : e"),
        ("a<ref>b<ref>c</ref></ref>d<br/>e<math>f</math><b>g</b>", "ad\neg"),
        ("-{zh-hans:计算机; zh-hant:電腦}- -{x}-", "计算机 x"),
        ("<!-- open", ""),
        ("", ""),
        ("<nowiki>'' [[x]]", "'' [[x]]"),
    ],
)
def test_wiki_scanner(source, text):
    assert markup.strip_wiki(source, frozenset({"file", "image", "category"})) == text


def test_wiki_scanner_is_linear_and_deep():
    import time

    start = time.time()
    none = frozenset()
    assert markup.strip_wiki("{{" * 100_000 + "}}" * 100_000 + "x", none) == "x"
    for piece in ("{{a|", "[[a|", "<ref>", "<!-", "[http://a ", "{|", "'''", "<a ", "}}", "= "):
        markup.strip_wiki(piece * 100_000, none)
    assert time.time() - start < 30


def test_html_text(spark):
    page = "<html><style>p{}</style><script>var x='</p>';</script><p>a&amp;b<b>c</p> &lt;d&gt;"
    assert column(spark, [page], markup.html_text) == ["a&b c <d>"]


def test_python_scorer_and_batch_modifier(spark):
    df = spark.createDataFrame([("a",), ("bbb",)], "text string")
    scorer = stages.PythonScorer(lambda s: s.str.len().astype("float64"), 2.0)
    upper = stages.modify(stages.batch_modifier(lambda s: s.str.upper(), batch_size=1))
    out = df.transform(stages.sequential(stages.score_filter(scorer, score_field="n"), upper))
    assert [tuple(r) for r in out.collect()] == [("BBB", 3.0)]


def _counted(tokens, n, separator):
    counts = Counter(zip(*(tokens[k:] for k in range(n)), strict=False))
    most = max(counts.values(), default=0)
    longest = max((sum(map(len, gram)) for gram, count in counts.items() if count == most), default=None)
    return n, most, 0 if longest is None else longest + separator * (n - 1)


def test_ngrams_counted_as_numbers_are_those_counted_as_tuples():
    rng = random.Random(5)
    for _ in range(500):
        tokens = [rng.choice(["a", "bb", "ccc", "é", "😀d"]) * rng.randint(1, 2) for _ in range(rng.randint(0, 12))]
        ns, separator = rng.sample(range(1, 14), 3), rng.randint(0, 1)
        assert repetition._tops(tokens, ns, separator) == [_counted(tokens, n, separator) for n in ns]
    # So many distinct tokens that n-grams have to be numbered anew.
    tokens = [str(rng.randrange(30_000)) for _ in range(40_000)] * 2
    assert repetition._tops(tokens, [2, 5, 9], 1) == [_counted(tokens, n, 1) for n in (2, 5, 9)]
