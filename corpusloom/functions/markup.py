"""Plain text from wiki markup and from raw HTML pages."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What opens or closes something in wiki markup, tags included.
_TOKEN = re.compile(
    r"<!--|\{\{\{(?!\{)|\{\{|\}\}\}|\}\}|(?<!\{)\{\||\|\}(?!\})|\[\[|\]\]|-\{|\}-|</?[A-Za-z][^<>]*>"
)
_CLOSES = {"}}}": "{{{", "}}": "{{", "|}": "{|", "]]": "[[", "}-": "-{"}
# Tags whose content is no running text.
_NO_TEXT = frozenset(
    "ref references math chem ce gallery timeline imagemap score graph mapframe maplink templatestyles "
    "syntaxhighlight source hiero categorytree".split()
)
_BREAKS = frozenset("br hr p div li tr".split())
# Names of the file and category namespaces that hold in every language.
NAMESPACES = ("File", "Image", "Category")
_OUTSIDE = re.compile(r"\[(?:(?:https?|ftp):)?//[^\s\[\]]+[ \t]*([^\[\]\n]*)\]")
_LINES: list[tuple[re.Pattern, str]] = [
    (re.compile(r"(?m)^(={1,6})[ \t]*([^\n]*?)[ \t]*\1[ \t]*$"), r"\2"),
    (re.compile(r"(?m)^[*#:;]+[ \t]*"), ""),
    (re.compile(r"'{2,5}"), ""),
    (re.compile(r"__[A-Z]{3,}__"), ""),
    (re.compile(r"\n{3,}"), "\n\n"),
]
HTML_RULES: list[tuple[str, str]] = [
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<script[^>]*>.*?</script>", " "),
    (r"(?is)<style[^>]*>.*?</style>", " "),
    (r"(?s)<[^>]*>", " "),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
    (r"[ \t\n\r\f]+", " "),
]


def _apply(text: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, rule: F.regexp_replace(t, rule[0], rule[1]), rules, text)


def _link(content: str, dropped: frozenset[str]) -> str:
    """What a reader sees of ``[[content]]``; nothing of files and categories."""
    target, bar, label = content.partition("|")
    if ":" in target and target.split(":", 1)[0].strip().replace("_", " ").casefold() in dropped:
        return ""
    return label if bar else target.strip().removeprefix(":")


def _converted(content: str) -> str:
    """Of ``-{content}-``, the first variant of a conversion or else the content."""
    if ":" not in content:
        return content
    first = content.split(";")[0]
    return first.split("=>")[-1].split(":", 1)[-1].strip()


class _Scan:
    """Text so far, and what is open: its kind, and where it begins in the text."""

    def __init__(self, dropped: frozenset[str]):
        self.dropped = dropped
        self.out: list[str] = []
        self.stack: list[tuple[str, int]] = []
        self.counts: dict[str, int] = {}

    def open(self, kind: str, written: str) -> None:
        """``written`` stays in the text if the thing is never closed."""
        self.counts[kind] = self.counts.get(kind, 0) + 1
        self.stack.append((kind, len(self.out)))
        self.out.append(written)

    def close(self, kind: str) -> bool:
        """Close the innermost thing of a kind; things open inside it end with it."""
        if not self.counts.get(kind):
            return False
        while True:
            inner, start = self.stack.pop()
            self.counts[inner] -= 1
            if inner == kind:
                break
        content = "".join(self.out[start + 1 :])
        del self.out[start:]
        if kind == "[[":
            self.out.append(_link(content, self.dropped))
        elif kind == "-{":
            self.out.append(_converted(content))
        return True

    def tag(self, token: str) -> None:
        name = re.match(r"</?([A-Za-z]+)", token)[1].lower()
        if name in _BREAKS:
            self.out.append("\n")
        elif name in _NO_TEXT and token.startswith("</"):
            self.close(name)
        elif name in _NO_TEXT and not token.endswith("/>"):
            self.open(name, "")


def strip_wiki(source: str, dropped: frozenset[str]) -> str:
    """The running text of wiki markup, in one pass whatever is nested in what.

    Templates, parameters, tables, files, categories, notes, comments and tags
    without text go; links and headings leave their text. Something that isn't closed
    is left as it is written, up to the end of what it is in.
    """
    scan, at = _Scan(dropped), 0
    while match := _TOKEN.search(source, at):
        scan.out.append(source[at : match.start()])
        token, at = match.group(), match.end()
        if token == "<!--":
            end = source.find("-->", at)
            at = len(source) if end < 0 else end + 3
        elif token in _CLOSES:
            # Three braces may close a template and be a brace of their own.
            if token == "}}}" and not scan.counts.get("{{{"):
                token, at = "}}", at - 1
            if not scan.close(_CLOSES[token]):
                scan.out.append(token)
        elif token[0] != "<":
            scan.open(token, token)
        elif re.match(r"<nowiki\b[^/]*>", token, re.I):
            end = source.find("</nowiki>", at)
            end = len(source) if end < 0 else end
            scan.out.append(source[at:end].replace("[", "\x01").replace("'", "\x02"))
            at = min(len(source), end + len("</nowiki>"))
        else:
            scan.tag(token)
    scan.out.append(source[at:])
    text = _OUTSIDE.sub(r"\1", "".join(scan.out))
    for pattern, replacement in _LINES:
        text = pattern.sub(replacement, text)
    return html.unescape(text).replace("\x01", "[").replace("\x02", "'").strip()


def wiki_text(markup: Column, namespaces: Sequence[str] = NAMESPACES) -> Column:
    """Plain text of wiki markup; links into ``namespaces`` (files, categories) leave nothing."""
    dropped = frozenset(name.replace("_", " ").casefold() for name in (*NAMESPACES, *namespaces))

    @F.pandas_udf("string")
    def strip(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: strip_wiki(text, dropped), na_action="ignore")

    # Not deterministic, so that a filter on the text does not scan twice.
    return strip.asNondeterministic()(markup)


def html_text(page: Column) -> Column:
    return F.regexp_replace(_apply(page, HTML_RULES), "^ | $", "")


def html_title(page: Column) -> Column:
    return F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1)
