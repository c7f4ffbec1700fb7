"""Wrapper induction: alignment by brute force, templates by value, odd and deep pages."""

from __future__ import annotations

import random
import time

import pytest

from corpusloom.llm import extract

PAGE = "page_id long, url string, html string"


def texts(spark, scratch, pages, host="h.example"):
    rows = [(i, f"http://{host}/{i}", page) for i, page in enumerate(pages)]
    out = extract.extract(spark.createDataFrame(rows, PAGE).repartition(3), scratch)
    return [r["text"] for r in sorted(out.collect(), key=lambda r: r["page_id"])]


def plain_match(mine, seed, a=0, b=0):
    """The largest number of nodes matched below a pair, trying every order-preserving matching."""
    xs = [(label, p) for p, (above, label) in mine.items() if above == a]
    ys = [(label, p) for p, (above, label) in seed.items() if above == b]

    def best(i, j):
        if i == len(xs) or j == len(ys):
            return 0
        out = max(best(i + 1, j), best(i, j + 1))
        if xs[i][0] == ys[j][0]:
            out = max(out, 1 + plain_match(mine, seed, xs[i][1], ys[j][1]) + best(i + 1, j + 1))
        return out

    return best(0, 0)


def random_tree(rng, first):
    nodes, paths = {}, [0]
    for k in range(rng.randrange(1, 12)):
        above = rng.choice(paths)
        taken = {label for a, label in nodes.values() if a == above}
        label = rng.choice([x for x in "abcdefgh" if x not in taken])
        nodes[first + k] = (above, label)
        paths.append(first + k)
    return nodes


@pytest.mark.parametrize("seed", range(40))
def test_alignment_matches_the_most_nodes(seed):
    rng = random.Random(seed)
    mine, other = random_tree(rng, 100), random_tree(rng, 500)
    found = extract.align(mine, other)
    assert len(found) == plain_match(mine, other)
    assert len(set(found.values())) == len(found)
    for x, y in found.items():
        assert mine[x][1] == other[y][1]
        assert found.get(mine[x][0], 0) == other[y][0]


def page(body, extra=""):
    return f"<html><body><h1>{body[:1]}</h1><div class=box>{extra}</div><p>{body}</p></body></html>"


def test_a_slot_that_says_something_else_stays(spark, scratch):
    got = texts(spark, scratch, [page("Same words here."), page("Same words here. "), page("Quite other words here.")])
    assert got[2].endswith("Quite other words here.")
    pages = [page(f"{i} own text of page {i}", "Sign the petition now") for i in range(6)]
    pages.append(page("7 own text", "A box with its own story"))
    got = texts(spark, scratch, pages)
    assert all("petition" not in t and f"own text of page {i}" in t for i, t in enumerate(got[:6]))
    assert "A box with its own story" in got[6]


def test_copies_of_a_page_are_one_page(spark, scratch):
    copies = [page("Copied words.", "Copied box")] * 10
    got = texts(spark, scratch, [*copies, page("Other words."), page("More words.")])
    assert got[0] == "C\nCopied box\nCopied words."


def test_unmarked_hosts_lose_what_all_their_pages_say(spark, scratch):
    frame = "<div id=top>The Daily</div><div class=text><p>{0} is news</p><p>and {0} more</p></div><div id=end>All rights</div>"
    got = texts(spark, scratch, [frame.format(f"Item {i}") for i in range(5)])
    assert got == [f"Item {i} is news\nand Item {i} more" for i in range(5)]
    # Two pages are too few to tell; and what is dropped comes from the induction alone.
    assert "The Daily" in texts(spark, scratch, [frame.format("a"), frame.format("b")], "i.example")[0]
    assert "The Daily" in extract.main_text(frame.format("Item 0"))


@pytest.mark.parametrize(
    "odd",
    ["<a " * 300_000, '<a "' * 300_001, "<p class='" * 300_001, "<!" * 300_000, "<li>x" * 100_000, "<ul><li>x" * 30_000, "<b>" * 200_000],
)
def test_odd_pages_are_read_in_one_pass(odd):
    start = time.time()
    extract.main_text(odd)
    assert time.time() - start < 10


def test_deep_pages_are_aligned(spark, scratch):
    deep = "<div>" * 3000 + "<section>t{0}" * 200
    got = texts(spark, scratch, [deep.format(i) for i in range(4)])
    assert got == ["\n".join([f"t{i}"] * 200) for i in range(4)]


def test_nulls_ties_and_repeated_rows(spark, scratch):
    rows = [(1, None, "<p>x y</p>"), (1, None, "<p>x y</p>"), (None, "", None), (None, None, None), (2, "http://h/", "")]
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "'old' as text", "1 as _key", "2 as host")
    out = extract.extract(df, scratch)
    assert out.columns == df.columns
    assert sorted(r["text"] for r in out.collect()) == ["", "", "", "x y", "x y"]
