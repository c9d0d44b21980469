"""Licence scans: identifier tags and notice phrases by Aho-Corasick, expressions by shunting-yard.

Nulls and edge cases: a null text counts as empty and has no words, no places and no labels
(empty strings, score 0). A null id is carried through. Repeated rows are scanned each for itself.
Places that overlap all count. Texts of any length are scanned whole; the memory needed is a few
times a slice of an Arrow batch, or the longest text. An empty table gives no rows. Other columns
than the id and the text are not read. A tag that names no known licence gets the label
``unknown``, and ``NONE`` and ``NOASSERTION`` none.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.llm.common import slices

# The base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Notices of well-known licences, in lower case, words only, with the family they name.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the mit license": "mit",
    "licensed under the apache license": "apache",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons": "cc",
    "licensed under cc by": "cc",
    "cc0 1 0 universal": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}

#: Families that an expression may be met with, and exceptions that make a copyleft licence so.
PERMISSIVE = frozenset(
    ["mit", "apache", "bsd", "isc", "bsl", "cc0", "unlicense", "zlib", "python", "0bsd"]
)
EXCEPTIONS = frozenset(["classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception"])

# Identifiers of the public SPDX licence list in common use, in lower case. Those of
# the GNU licences are made by the rule below.
IDENTIFIERS = frozenset(
    """
    0bsd aal afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 apache-1.0 apache-1.1 apache-2.0 apl-1.0
    apsl-1.0 apsl-1.1 apsl-1.2 apsl-2.0 artistic-1.0 artistic-1.0-perl artistic-2.0
    blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause
    bsd-3-clause-clear bsd-3-clause-lbnl bsd-4-clause bsd-4-clause-uc bsl-1.0 busl-1.1
    bzip2-1.0.6 cal-1.0 catosl-1.1 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0
    cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0
    cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpal-1.0 cpl-1.0
    curl ecl-1.0 ecl-2.0 efl-1.0 efl-2.0 elastic-2.0 entessa epl-1.0 epl-2.0 eupl-1.1
    eupl-1.2 fair ftl hpnd icu ijg imlib2 intel ipa ipl-1.0 isc json libpng libpng-2.0 libtiff
    lppl-1.3c lpl-1.02 miros mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0
    mpl-2.0-no-copyleft-exception ms-pl ms-rl mulanpsl-2.0 multics naumen ncsa ntp odbl-1.0
    ofl-1.0 ofl-1.1 openssl osl-1.0 osl-2.0 osl-2.1 osl-3.0 php-3.0 php-3.01 postgresql
    psf-2.0 python-2.0 qpl-1.0 ruby simpl-2.0 sleepycat sspl-1.0 unicode-3.0 unicode-dfs-2016
    unlicense upl-1.0 vim vsl-1.0 w3c wtfpl x11 xnet zlib zpl-2.0 zpl-2.1
    """.split()
) | frozenset(
    f"{name}-{version}{ending}"
    for name, versions in {
        "gpl": ("1.0", "2.0", "3.0"), "lgpl": ("2.0", "2.1", "3.0"), "agpl": ("1.0", "3.0"),
        "gfdl": ("1.1", "1.2", "1.3"),
    }.items()
    for version in versions
    for ending in ("", "-only", "-or-later")
)
#: What a tag says where no licence is named.
NO_LICENCE = frozenset(["none", "noassertion"])
UNKNOWN = "unknown"

#: Bytes of text that are scanned at a time.
SLICE_BYTES = 4 << 20

TAG = "spdx license identifier"
_TAG_LINE = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)")
# An identifier ends before signs that close a comment, as in "mit-->".
_TOKEN = re.compile(r"\(|\)|[a-z0-9]+(?:[.:-][a-z0-9]+)*\+?|\S")
_RANK = {"or": 1, "and": 2, "with": 3}

# A-Z become a-z; all other bytes below 128 but 0-9 and a-z become a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

SCHEMA = (
    "{id} {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    " base_labels string, labels string, score double, expressions array<string>,"
    " permissive boolean, spans array<struct<label:string,word:bigint,n_words:bigint>>"
)


def family(identifier: str) -> str:
    """The family of a licence identifier: its name up to the version."""
    name = identifier.rstrip("+").split("-")[0]
    return {"cc0": "cc0", "bsl": "bsl", "psf": "python", "python": "python"}.get(name, name)


def is_known(identifier: str, identifiers: Collection[str]) -> bool:
    """Whether a licence is listed; a sign for later versions does not matter."""
    return identifier.removesuffix("+") in identifiers


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: operands and operators in postfix order; None if it is not well formed.

    WITH binds before AND, AND before OR. What follows the first foreign sign is a comment.
    """
    tokens = []
    for token in _TOKEN.findall(expression.lower()):
        if not (token in "()" or token[0].isalnum()):
            break
        tokens.append(token)
    out: list[str] = []
    waiting: list[str] = []
    operand = False  # whether an operand has just ended
    for token in tokens:
        if token == "(":
            if operand:
                return None
            waiting.append(token)
        elif token == ")":
            if not operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif token in _RANK:
            if not operand:
                return None
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = False
        else:
            if operand:
                return None
            out.append(token)
            operand = True
    if not operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(
    tokens: Iterable[str],
    permissive: Collection[str] = PERMISSIVE,
    exceptions: Collection[str] = EXCEPTIONS,
    identifiers: Collection[str] = IDENTIFIERS,
) -> tuple[set[str], bool]:
    """Families named by a postfix expression, and whether permissive licences can meet it.

    A licence that is not listed is of the family ``unknown``.
    """
    families: set[str] = set()
    stack: list[tuple[str, bool]] = []

    def named(token: str) -> str:
        if token in NO_LICENCE:
            return ""
        return family(token) if is_known(token, identifiers) else UNKNOWN

    for token in tokens:
        if token not in _RANK:
            stack.append((token, named(token) in permissive))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            families.add(named(left[0]) if left[0] else "")
            stack.append(("", left[1] or right[0] in exceptions))
            continue
        families.update(named(name) for name, _ in (left, right) if name)
        met = left[1] or right[1] if token == "or" else left[1] and right[1]
        stack.append(("", met))
    name, met = stack.pop()
    if name:
        families.add(named(name))
    return families - {""}, met


def _automaton(phrases: Mapping[str, tuple[str, bool]]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, (label, base) in phrases.items():
        found.add_word(f" {phrase} ", (label, base, phrase.count(" ") + 1, len(phrase) + 2))
    found.make_automaton()
    return found


def _scan(raw: bytes, automaton, permissive, exceptions, identifiers) -> dict:
    words = raw.translate(_WORD_BYTES).split()
    text = " " + b" ".join(words).decode("latin-1") + " "
    places = sorted(
        (end - size + 1, label, base, n) for end, (label, base, n, size) in automaton.iter(text)
    )
    spans, base_spans = [], []
    at = word = 0  # words start after a space; spaces are counted once, from left to right
    tagged = False
    for begin, label, base, n in places:
        word += text.count(" ", at, begin)
        at = begin
        if label is None:
            tagged = True
            continue
        if base:
            base_spans.append((label, word))
        spans.append({"label": label, "word": word, "n_words": n})
    base_labels = {label for label, _ in base_spans}
    labels = {s["label"] for s in spans}
    expressions, met, broken, known = [], [], False, False
    if tagged:
        for match in _TAG_LINE.finditer(raw.translate(_LOWER)):
            tokens = postfix(match[1].decode("utf-8", "replace"))
            if tokens is None:
                broken = True
                continue
            named, good = evaluate(tokens, permissive, exceptions, identifiers)
            if not named:
                continue
            labels |= named
            known |= named != {UNKNOWN}
            expressions.append(" ".join(tokens))
            met.append(good)
    if known:
        score = 1.0
    elif len(spans) > len(base_spans):
        score = 0.9
    elif base_spans:
        score = 0.8
    elif expressions:
        score = 0.5
    else:
        score = 0.3 if broken else 0.0
    if not met and labels:
        met = [labels <= set(permissive)]
    return {
        "n_words": len(words),
        "n_base": len(base_spans),
        "first_word": base_spans[0][1] if base_spans else None,
        "last_word": base_spans[-1][1] if base_spans else None,
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        "score": score,
        "expressions": expressions,
        "permissive": all(met) if met else None,
        "spans": spans,
    }


def scan_licenses(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: Mapping[str, str] = NOTICES,
    permissive: Collection[str] = PERMISSIVE,
    exceptions: Collection[str] = EXCEPTIONS,
    identifiers: Collection[str] = IDENTIFIERS,
) -> DataFrame:
    """One row per document: words, places of the base phrases, labels, expressions and spans.

    Words are runs of a-z (A-Z lowered), 0-9 and non-ASCII characters. ``labels`` are the base
    labels, those of ``notices`` and the families in identifier tags; a name in a tag that
    ``identifiers`` (in lower case) does not have is ``unknown``. ``permissive`` says whether
    all expressions found (else all labels) can be met by permissive licences; null without any.
    ``score`` is 1 for a well-formed tag with a known licence, 0.9 for a notice, 0.8 for a base
    phrase alone, 0.5 for unknown names in tags, 0.3 for a tag that cannot be read. There is no
    shuffle.
    """
    phrases: dict[str, tuple[str | None, bool]] = {TAG: (None, False)}
    phrases |= {phrase: (label, False) for phrase, label in notices.items()}
    phrases |= {phrase: (label, True) for phrase, label in BASE_PHRASES.items()}
    may, but, listed = frozenset(permissive), frozenset(exceptions), frozenset(identifiers)
    chosen = df.select(id_col, text_col)
    kind = chosen.schema[id_col].dataType.simpleString()
    result = SCHEMA.format(id=f"`{id_col}`", kind=kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(phrases)
        for batch in slices(batches, text_col, SLICE_BYTES):
            texts = batch.column(1).cast(pa.large_binary())
            rows = [_scan(t.as_py() or b"", automaton, may, but, listed) for t in texts]
            names = [n.split()[0] for n in SCHEMA.split(", ")[1:]]
            columns = [pa.array([r[n] for r in rows], type=_ARROW[n]) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *names])

    return chosen.mapInArrow(scan, result)


_ARROW = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(),
    "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(),
    "score": pa.float64(), "expressions": pa.list_(pa.string()), "permissive": pa.bool_(),
    "spans": pa.list_(
        pa.struct([("label", pa.string()), ("word", pa.int64()), ("n_words", pa.int64())])
    ),
}
