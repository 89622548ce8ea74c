"""Licence tags, notice phrases and licence expressions in texts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import table, text_of

# Phrases that count as base notices, with their labels.
BASE = {
    "apache license": "apache",
    "cc by": "cc-by",
    "gnu general public license": "gpl",
    "mit license": "mit",
}
# Further notice phrases, with their labels.
NOTICES = {
    "affero general public license": "agpl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "bsd 2 clause license": "bsd",
    "bsd 3 clause license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nc nd": "cc-by-nc-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "dedicated to the public domain": "public-domain",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "gnu free documentation license": "gfdl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "unlicense": "unlicense",
    "zlib license": "zlib",
}
# Words before a licence expression.
TAGS = ("licenseinfoinfile", "packagelicenseconcluded", "packagelicensedeclared", "spdx license identifier")
# Exceptions that may follow "with" in a notice.
EXCEPTIONS = ("classpath exception", "gcc runtime library exception", "linking exception", "llvm exception", "llvm exceptions")
# Words that may stand between two licences joined by "and" or "or".
FILLERS = frozenset("1 2 3 4 0 a an any at either later newer of only option or the them under v1 v2 v3 version your".split())
# How much a licence asks of who uses the text, from nothing (0) to the most (1).
BURDEN = {
    "0bsd": 0.1, "agpl": 0.9, "apache": 0.3, "bsd": 0.3, "bsl": 0.3, "cc-by": 0.3, "cc-by-nc": 1.0, "cc-by-nc-nd": 1.0,
    "cc-by-nc-sa": 1.0, "cc-by-nd": 1.0, "cc-by-sa": 0.7, "cc0": 0.1, "epl": 0.6, "eupl": 0.7, "gfdl": 0.8, "gpl": 0.8,
    "isc": 0.3, "lgpl": 0.6, "mit": 0.3, "mpl": 0.6, "public-domain": 0.1, "unlicense": 0.1, "zlib": 0.3,
}
#: The burden of a licence that is not listed, and what an exception takes off.
UNLISTED, RELIEF = 0.5, 0.3

#: Lower case for A-Z, a space for every ASCII byte that is not a letter or digit; other bytes are parts of words.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:_-]*|\S")
_NAME = re.compile(r"[a-z0-9][a-z0-9.+:_-]*")
_RANK = {"or": 1, "and": 2, "with": 3}


def family(name: str) -> str:
    """The label of a licence identifier: lower case, without version and what follows it."""
    return re.sub(r"(?<=.)-v?\d.*$|(?<=.)(-only|-or-later|\+)$", "", name.lower())


@dataclass(frozen=True)
class Choice:
    """An evaluated expression: all labels it names, the labels its lightest alternative asks for, and their burden."""

    labels: frozenset[str]
    chosen: frozenset[str]
    burden: float

    @classmethod
    def of(cls, label: str) -> Choice:
        return cls(frozenset([label]), frozenset([label]), BURDEN.get(label, UNLISTED))

    def join(self, op: str, other: Choice) -> Choice:
        labels = self.labels | other.labels
        if op == "and":
            return Choice(labels, self.chosen | other.chosen, max(self.burden, other.burden))
        light = min(self, other, key=lambda c: (c.burden, sorted(c.chosen)))
        return Choice(labels, light.chosen, light.burden)

    def relieved(self) -> Choice:
        return Choice(self.labels, self.chosen, max(0.0, round(self.burden - RELIEF, 6)))


def evaluate(tokens: Iterable[str]) -> tuple[Choice | None, str]:
    """A licence expression by the shunting-yard algorithm: its value and the tokens used.

    Operators in any case: WITH before AND before OR, parentheses before all.
    What cannot go on (a name after a name, a closing parenthesis too many, a
    sign) ends the expression; an operator left without its right side and a
    parenthesis left open are dropped. Without any licence the value is None.
    """
    values: list[Choice] = []
    stack: list[str] = []
    used: list[str] = []
    want_name = True

    def apply(op: str) -> None:
        right = values.pop()
        values.append(values.pop().join(op, right))

    for token in tokens:
        low = token.lower()
        if want_name:
            if low == "(":
                stack.append(low)
            elif low in _RANK or not _NAME.fullmatch(low):
                break
            elif stack and stack[-1] == "with":
                stack.pop()
                values.append(values.pop().relieved())
                want_name = False
            else:
                values.append(Choice.of(family(low)))
                want_name = False
        elif low == ")":
            if "(" not in stack:
                break
            while stack[-1] != "(":
                apply(stack.pop())
            stack.pop()
        elif low in _RANK:
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[low]:
                apply(stack.pop())
            stack.append(low)
            want_name = True
        else:
            break
        used.append(token)
    while used and want_name:  # an open end
        if used[-1].lower() not in _RANK and used[-1] != "(":
            break
        stack.pop()
        if used.pop() == "(":
            continue
        want_name = False
    while stack:
        if (op := stack.pop()) != "(":
            apply(op)
    return (values[0] if values else None), " ".join(used)


def automaton():
    """All phrases, exceptions and tags as one Aho-Corasick automaton over words."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, label in (BASE | NOTICES).items():
        found.add_word(f" {phrase} ", ("phrase", phrase, label))
    for phrase in EXCEPTIONS:
        found.add_word(f" {phrase} ", ("exception", phrase, None))
    for phrase in TAGS:
        found.add_word(f" {phrase} ", ("tag", phrase, None))
    found.make_automaton()
    return found


def _line(body: bytes, at: int) -> list[str]:
    """Tokens of the rest of a line."""
    stop = min((x for x in (body.find(b"\n", at), body.find(b"\r", at)) if x >= 0), default=len(body))
    return _TOKEN.findall(body[at:stop].decode("utf-8", "replace").lstrip(" \t:=\"'"))


def scan(automaton, body: bytes) -> tuple[int, list[tuple], list[tuple]]:
    """Words of a text, phrase hits (first word, words, phrase, label), expressions (first word, text, labels, chosen, burden)."""
    words = body.translate(WORDS).split()
    if not words:
        return 0, [], []
    joined = b" " + b" ".join(words) + b" "
    hits, at, index = [], 0, 0
    for end, (kind, phrase, label) in automaton.iter(joined.decode("latin-1")):
        start = end - len(phrase) - 1
        index += joined.count(b" ", at, start) if start >= at else -joined.count(b" ", start, at)
        at = start
        hits.append((index, phrase.count(" ") + 1, phrase, label, kind))
    hits.sort()
    phrases = [h[:4] for h in hits if h[4] == "phrase"]
    if not hits:
        return len(words), [], []
    found, whole, beyond = [], [], -1
    for hit in sorted(hits, key=lambda h: (h[0], -h[1])):  # leftmost longest, for expressions only
        if hit[0] > beyond:
            whole.append(hit)
            beyond = hit[0] + hit[1] - 1
    ends = [m.end() for m in _WORD.finditer(body)] if any(h[4] == "tag" for h in whole) else []
    k = 0
    while k < len(whole):
        first, size, phrase, label, kind = whole[k]
        k += 1
        if kind == "exception":
            continue
        if kind == "tag":
            value, text = evaluate(_line(body, ends[first + size - 1]))
        else:
            tokens, reach = [label], first + size
            while k < len(whole) and whole[k][4] != "tag":
                op = _joint(words[reach:whole[k][0]], whole[k][4])
                if not op:
                    break
                tokens += [op, (whole[k][3] or whole[k][2]).replace(" ", "-")]
                reach = whole[k][0] + whole[k][1]
                k += 1
            value, text = evaluate(tokens)
        if value:
            found.append((first, text, sorted(value.labels), sorted(value.chosen), value.burden))
    return len(words), phrases, found


def _joint(between: list[bytes], kind: str) -> str | None:
    """The operator that a few words between two hits state, if they state one."""
    if len(between) > 8:
        return None
    if kind == "exception":
        return "with" if b"with" in between[-3:] else None
    said = re.sub(r"\bor (any )?(later|newer)\b", "", b" ".join(between).decode("latin-1")).split()
    if not {"and", "or"} & set(said) or not set(said) <= FILLERS | {"and"}:
        return None
    return "or" if "or" in said else "and"


_SHAPE = ("id long, n_words long, hits array<struct<word:long,n_words:int,phrase:string,label:string>>, "
          "expressions array<struct<word:long,text:string,labels:array<string>,chosen:array<string>,burden:double>>")
_HITS = pa.list_(pa.struct([("word", pa.int64()), ("n_words", pa.int32()), ("phrase", pa.string()), ("label", pa.string())]))
_EXPRESSIONS = pa.list_(pa.struct([("word", pa.int64()), ("text", pa.string()), ("labels", pa.list_(pa.string())),
                                   ("chosen", pa.list_(pa.string())), ("burden", pa.float64())]))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    search = automaton()
    for batch in batches:
        counts, hits, expressions = [], [], []
        for body in batch.column(1):
            n, h, e = scan(search, bytes(memoryview(body.as_buffer())))
            counts.append(n)
            hits.append([dict(zip(("word", "n_words", "phrase", "label"), x, strict=True)) for x in h])
            expressions.append([dict(zip(("word", "text", "labels", "chosen", "burden"), x, strict=True)) for x in e])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(hits, _HITS), pa.array(expressions, _EXPRESSIONS)],
                                         ["id", "n_words", "hits", "expressions"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What every text says of its licence.

    Returns one row per input row: the id, ``n_words``, ``hits`` (every place
    where the words of a phrase stand side by side, overlaps included),
    ``expressions`` (from tags, and from notices joined by and, or, with: the
    expression, all its labels, the labels of the alternative that asks least,
    and its burden), ``labels`` (of hits and expressions, distinct and sorted)
    and ``burden``: 0 where nothing is found, otherwise that of the heaviest
    expression, as all notices of a text hold together.

    Words are runs of ASCII letters and digits and of all characters beyond
    ASCII, with A-Z in lower case. One Aho-Corasick automaton over the words
    finds tags, phrases and exceptions in one pass; expressions are parsed by
    the shunting-yard algorithm. Nothing is shuffled, no text is cut.

    Defined results: null and empty texts have no words and burden 0; repeated
    rows give equal rows; rows without an id stay; an empty table gives an
    empty result. Only the two columns named are read.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).cast("binary").alias("text"))
    found = slim.mapInArrow(_scan_batches, _SHAPE)
    named = F.concat(F.transform("hits", lambda h: h["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"])))
    burden = F.coalesce(F.array_max(F.transform("expressions", lambda e: e["burden"])), F.lit(0.0))
    return found.select(F.col("id").alias(id_col), "n_words", "hits", "expressions",
                        F.array_sort(F.array_distinct(named)).alias("labels"), burden.alias("burden"))


def _base(column: str) -> Column:
    return F.filter(column, lambda h: h["phrase"].isin(*BASE))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of all documents; ``score`` is the burden."""
    found = scan_licenses(table(spark, sf_dir, "documents")).withColumn("base", _base("hits"))
    starts = F.transform("base", lambda h: h["word"])
    names = F.array_sort(F.array_distinct(F.transform("base", lambda h: h["label"])))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.concat_ws(",", names).alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), F.col("burden").alias("score"),
        F.transform("expressions", lambda e: e["text"]).alias("expressions"))
