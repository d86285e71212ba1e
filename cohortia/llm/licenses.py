"""License scans: identifier tags and notice phrases, and what they ask for together.

One Aho-Corasick automaton reads a text's words once and finds every notice phrase and
every identifier tag (``SPDX-License-Identifier:``).  The expression behind a tag is
turned to postfix order by a shunting-yard parser (``with`` binds before ``and``, that
before ``or``) and evaluated: ``or`` leaves the choice of the freer side, ``and``
asks for both, so the stricter counts, and an exception (``with``) eases its licence.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortia.llm.tokens import in_steps

#: fixed values: notice phrases of the base and their labels
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: notice phrases of the method's own labels
PHRASES = {
    "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by sa": "cc-by-sa", "creative commons attribution": "cc-by",
    "cc0": "cc0", "public domain": "public-domain", "the unlicense": "unlicense",
    "mit license": "mit", "mit licence": "mit", "permission is hereby granted free of charge": "mit",
    "apache license": "apache", "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd", "isc license": "isc",
    "mozilla public license": "mpl", "eclipse public license": "epl",
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "general public licence": "gpl", "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
}
TAGS = ("spdx-license-identifier", "license-expression")
#: how strict a licence is, by the longest beginning of its identifier; anything else counts as UNKNOWN
STRICT = {
    "cc0": 0.1, "public-domain": 0.1, "unlicense": 0.1, "0bsd": 0.1, "wtfpl": 0.1,
    "mit": 0.25, "apache": 0.25, "bsd": 0.25, "isc": 0.25, "zlib": 0.25, "cc-by": 0.25,
    "mpl": 0.5, "lgpl": 0.5, "epl": 0.5, "cddl": 0.5, "cc-by-sa": 0.75, "gpl": 0.75, "agpl": 0.75,
    "cc-by-nc": 0.9, "cc-by-nd": 0.9, "reserved": 1.0,
}
UNKNOWN, EASED = 0.6, 0.5
BINDS = {"or": 1, "and": 2, "with": 3}
_WORD = bytes(c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c >= 128 else 32 for c in bytes(range(256)).lower())
_TAG = re.compile(rf"(?:{'|'.join(TAGS)})[ \t]*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9.+:-]*[a-z0-9+]|\S")


def strictness(license_id: str) -> float:
    known = [k for k in STRICT if license_id == k or license_id.startswith(f"{k}-")]
    return STRICT[max(known, key=len)] if known else UNKNOWN


def postfix(text: str) -> tuple[list[str], bool]:
    """(postfix tokens, sound) of the expression a text begins with (lower case).

    It ends before the first token that can't go on; a missing operand or parenthesis
    makes it unsound, and the identifiers read so far are left in order.
    """
    out, stack, operand, ids = [], [], True, []
    for token in _TOKEN.findall(text):
        name = token not in BINDS and bool(re.fullmatch(r"[a-z0-9.+:-]+", token))
        if operand and name:
            out.append(token)
            ids.append(token)
            operand = False
        elif operand and token == "(":
            stack.append(token)
        elif not operand and token in BINDS:
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        elif not operand and token == ")" and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            break
    if operand or "(" in stack:
        return ids, False
    return out + stack[::-1], True


def evaluate(text: str) -> tuple[list[str], float, bool]:
    """(labels, strictness, sound) of an expression; all identifiers of an unsound one count."""
    tokens, sound = postfix(text.lower())
    if not sound:
        return sorted(set(tokens)), max(map(strictness, tokens), default=0.0), False
    stack: list[tuple[set[str], float]] = []
    for token in tokens:
        if token not in BINDS:
            stack.append(({token}, strictness(token)))
            continue
        (right, strict2), (left, strict) = stack.pop(), stack.pop()
        if token == "with":
            stack.append(({f"{x}-with-{y}" for x in left for y in right}, strict * EASED))
        else:
            stack.append((left | right, max(strict, strict2) if token == "and" else min(strict, strict2)))
    (labels, strict), = stack
    return sorted(labels), strict, True


def _automaton(phrases: dict[str, tuple[str, bool]]):
    import ahocorasick
    out = ahocorasick.Automaton()
    for phrase, (label, base) in phrases.items():
        words = phrase.encode().lower().translate(_WORD).split()
        out.add_word(" ".join(["", *(w.decode("latin-1") for w in words), ""]), (label, base, len(words)))
    out.make_automaton()
    return out


def scan_licenses(docs: DataFrame, base: dict[str, str] | None = None, phrases: dict[str, str] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, places, expressions, labels, score.

    Words are runs of a-z (A-Z lower-cased), 0-9 and anything beyond ASCII.  ``places`` are all
    (label, start, words, base) where a phrase's words stand consecutively, by start word and label;
    ``expressions`` all (text, labels, strictness, sound) behind identifier tags, which end with
    their line.  ``labels`` has those of both, distinct and sorted.  ``score`` is how strict
    the document's statements are together, as all of them hold: 0 without any, 1 where all rights
    are reserved.  Null and empty texts have no words and score 0; null and repeated ids keep
    their rows; other columns aren't read; an empty table gives no rows.  A text is read whole
    by one task, however long, in memory of a few times its size.
    """
    base, phrases = BASE_PHRASES if base is None else base, PHRASES if phrases is None else phrases
    wanted = {p: (label, False) for p, label in phrases.items()} | {p: (label, True) for p, label in base.items()}
    wanted |= {tag: ("", False) for tag in TAGS}
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)] + T._parse_datatype_string(
        "n_words long, places array<struct<label:string,start:long,words:int,base:boolean>>, "
        "expressions array<struct<text:string,labels:array<string>,strictness:double,sound:boolean>>, "
        "labels array<string>, score double").fields)
    types = [pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int32()), ("base", pa.bool_())])),
             pa.list_(pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())), ("strictness", pa.float64()),
                                 ("sound", pa.bool_())])), pa.list_(pa.string()), pa.float64()]

    def one(text: str | None, automaton) -> tuple:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.translate(_WORD).split()
        line = b" ".join([b"", *words, b""])
        hits = list(automaton.iter(line.decode("latin-1")))
        if not hits:
            return len(words), [], [], [], 0.0
        space = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        start = np.searchsorted(space, [end for end, _ in hits]) - [n for _, (_, _, n) in hits]
        places = sorted((label, int(s), n, own) for s, (_, (label, own, n)) in zip(start, hits, strict=True) if label)
        places.sort(key=lambda p: p[1])
        found = []
        if any(not label for _, (label, _, _) in hits):
            low = raw.lower().decode("utf-8", "replace")
            for m in _TAG.finditer(low):
                expression = re.sub(r"\s*(\*/|-->).*", "", m[1])
                found.append((expression, *evaluate(expression)))
        labels = sorted({p[0] for p in places} | {x for e in found for x in e[1]})
        score = max([strictness(p[0]) for p in places] + [e[2] for e in found], default=0.0)
        return len(words), places, found, labels, score

    def scan(batches):
        automaton = _automaton(wanted)
        names = [["label", "start", "words", "base"], ["text", "labels", "strictness", "sound"]]
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in in_steps(texts):
                columns = [list(c) for c in zip(*(one(t, automaton) for t in texts[lo:hi]), strict=True)]
                for i, keys in enumerate(names, 1):
                    columns[i] = [[dict(zip(keys, x, strict=True)) for x in row] for row in columns[i]]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *(
                    pa.array(c, t) for c, t in zip(columns, types, strict=True))], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(scan, schema)
