"""Detection and anonymisation of personal data by entity patterns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let

# Default entities, in the order in which they are applied.
PATTERNS: dict[str, str] = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "PHONE_NUMBER": r"\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{3}-\d{3}-\d{4}\b",
}
# Further entities, which are looked for when they are named.
MORE_PATTERNS: dict[str, str] = {
    "CREDIT_CARD": r"\b(?:\d[ -]?){12,18}\d\b",
    "IBAN_CODE": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "US_SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "MAC_ADDRESS": r"\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b",
    "CRYPTO": r"\b(?:bc1[a-z0-9]{25,59}|[13][a-km-zA-HJ-NP-Z1-9]{25,34})\b",
    "URL": r"\bhttps?://[^\s<>\"]+",
}
ACTIONS = ("replace", "redact", "mask", "hash", "encrypt")


def luhn(number: Column) -> Column:
    """Whether the last digit checks the others, as on payment cards."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(number, "[^0-9]", "")), ""), lambda d: d.cast("int"))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


# Entities whose pattern is not enough.
CHECKS: dict[str, Callable[[Column], Column]] = {"CREDIT_CARD": luhn}


def resolve_entities(
    entities: Sequence[str] | None = None, patterns: Mapping[str, str] | None = None
) -> list[tuple[str, str]]:
    """``[(entity, pattern)]``; ``patterns`` adds to or overrides the built-in ones.

    Without ``entities``, the default ones and those of ``patterns``.
    """
    known = {**PATTERNS, **MORE_PATTERNS, **(patterns or {})}
    wanted = list(entities) if entities else [*PATTERNS, *(patterns or {})]
    unknown = [e for e in wanted if e not in known]
    if unknown:
        raise ValueError(f"no pattern for entities {unknown}; pass one in `patterns`")
    return [(entity, known[entity]) for entity in known if entity in wanted]


def rewrite_matches(text: Column, pattern: str, rewrite: Callable[[Column], Column]) -> Column:
    """Apply ``rewrite`` to each match in place.

    The text between matches and the matches themselves are zipped back
    together: linear in the text, and only the matched positions change.
    """

    def rewritten(value: Column) -> Column:
        parts = F.zip_with(
            F.split(value, pattern, -1),
            F.regexp_extract_all(value, F.lit(pattern), F.lit(0)),
            lambda gap, match: F.concat(gap, F.coalesce(rewrite(match), F.lit(""))),
        )
        return F.when(F.regexp_like(value, F.lit(pattern)), F.array_join(parts, "")).otherwise(value)

    # Bound, or each entity would repeat the work of those before it several times.
    return let(text, rewritten)


def anonymize(
    text: Column,
    action: str = "replace",
    entities: Sequence[str] | None = None,
    patterns: Mapping[str, str] | None = None,
    key: Column | None = None,
) -> Column:
    """Anonymise every entity of the text.

    ``key`` is needed by ``encrypt`` only: a column with a 16-, 24- or 32-byte
    AES key. ``corpusloom.operators.stages.pii_stage`` adds one from a scalar
    subquery, so that no plan shows the key.
    """
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}, expected one of {ACTIONS}")
    if action == "encrypt" and key is None:
        raise ValueError("encrypt needs a key")
    changes: dict[str, Callable[[str], Callable[[Column], Column]]] = {
        "replace": lambda entity: lambda m: F.lit(f"<{entity}>"),
        "redact": lambda entity: lambda m: F.lit(""),
        "mask": lambda entity: lambda m: F.repeat(F.lit("*"), F.length(m)),
        "hash": lambda entity: lambda m: F.sha2(m.cast("binary"), 256),
        "encrypt": lambda entity: lambda m: F.base64(F.aes_encrypt(m, key)),
    }
    for entity, pattern in resolve_entities(entities, patterns):
        change, check = changes[action](entity), CHECKS.get(entity)
        if check is not None:
            text = rewrite_matches(text, pattern, lambda m, f=change, ok=check: F.when(ok(m), f(m)).otherwise(m))
        elif action in ("replace", "redact"):
            text = F.regexp_replace(text, pattern, f"<{entity}>" if action == "replace" else "")
        else:
            text = rewrite_matches(text, pattern, change)
    return text


def findings(
    text: Column,
    entities: Sequence[str] | None = None,
    patterns: Mapping[str, str] | None = None,
) -> Column:
    """``array<struct(entity, position, value)>`` of all entities found."""
    return F.concat(
        *[_matches(text, e, pattern) for e, pattern in resolve_entities(entities, patterns)]
    )


def _matches(text: Column, entity: str, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if entity in CHECKS:
        found = F.filter(found, CHECKS[entity])
    return F.transform(
        found,
        lambda value, i: F.struct(
            F.lit(entity).alias("entity"),
            i.cast("bigint").alias("position"),
            value.alias("value"),
        ),
    )
