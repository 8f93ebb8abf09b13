"""Secret scans (operator 2): assignment-aware lexing.

Base patterns find what looks like a secret by itself. The method adds what only the syntax shows: source and
configuration text is lexed into names, operators and literals; ``name = literal`` pairs are collected, constants
are propagated through later references and ``+`` concatenations, and a literal is scored by how sensitive the
names are that it reaches. Everything is one pass over each text, so there is no shuffle.

Null and empty texts have no spans; a null doc_id is kept; repeated rows each get their own result; an empty table
gives an empty table; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpanel.llm.common import small_batches, table

KINDS = ("assign", "access", "hex", "literal")

_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_KEYWORD = re.compile(r"(?ai)pass|secret|token|api")
# Runs are maximal, so a minimum length inside the pattern drops just the matches that are too short.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

# How sensitive a word of a name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "authorization": 0.8, "auth": 0.6, "private": 0.6,
    "access": 0.5, "signing": 0.6, "encryption": 0.6, "webhook": 0.6, "dsn": 0.6, "key": 0.4,
}
# Literals that stand for a secret without being one.
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "dummy", "xxxx", "none", "null", "true", "false", "redacted")

_TOKEN = re.compile(
    r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    r"""|(?P<op>:=|=>|==|[=:](?!//))|(?P<plus>\+)|(?P<end>[,;{}()\[\]#])"""
    r"""|(?P<word>[A-Za-z_$][\w$]*(?:[.\-][\w$]+)*)|(?P<bare>[^\s"'`,;{}()\[\]#=:+]+)"""
)
# An unquoted value; the word that it starts with; what may join its end to a literal without white space.
_RUN = re.compile(r"""[^\s"'`,;{}()\[\]]*""")
_LEAD = re.compile(r"[A-Za-z_$][\w$]*(?:[.\-][\w$]+)*")
_JOINT = re.compile(r"(?:[=:]+>?|\+)?$")
_BLANK = re.compile(r"(?:\s|\\\n)*")
_BETWEEN = re.compile(r"[^0-9a-z]+")
# A line whose value follows on the next one; one that opens a value in parentheses; a line of nothing but its literals.
_GOES_ON = re.compile(r"(?:[=:+]|=>|\\)[ \t\r]*$")
_OPENS = re.compile(r"(?:[=:]|=>)[ \t]*\([ \t\r]*$")
_LITERALS = re.compile(r"""\s*(?:[A-Za-z]{0,2}(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')\s*\+?\s*)*(\)?)""")
# Names whose value is a block of lines: a triple-quoted literal, or indented lines under a block mark.
_TRIPLE = re.compile(r"""([A-Za-z_$][\w$]*(?:[.\-][\w$]+)*)["']?\]?[ \t]*(?::=|=>|[=:])[ \t]*\(?[ \t]*[A-Za-z]{0,2}(\"{3}|'{3})((?:(?!\2)[^\\]|\\.)*+)\2""", re.S)
_BLOCK = re.compile(r"""^([ \t]*)(?:- )?["']?([A-Za-z_$][\w$]*(?:[.\-][\w$]+)*)["']?[ \t]*:[ \t]*[|>][+\-0-9]*[ \t\r]*\n((?:\1[ \t]+\S[^\n]*(?:\n|\Z)|[ \t\r]*\n)+)""", re.M)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """0 to 1: how surely a variable of this name holds a secret."""
    words = [w.lower() for w in _WORDS.findall(name)]
    joined = {a + b for a, b in zip(words, words[1:])}
    weights = [SENSITIVE[w] for w in {*words, *joined} if w in SENSITIVE]
    return min(1.0, max(weights, default=0.0) + 0.3 * max(0, len(weights) - 1))


_LONGEST = max(map(len, PLACEHOLDERS))


def _placeholder(word: str) -> bool:
    return word in PLACEHOLDERS or len(word) >= 4 and not word.strip("x")


class _Value:
    """What a name stands for: spans of the text and other values, shared by reference."""

    __slots__ = ("parts", "facts")

    def __init__(self, parts: tuple):
        self.parts, self.facts = parts, None


def _facts(value: str) -> tuple:
    """What a score needs: length, counts of characters, the first, if a word inside is a placeholder, the words at both
    ends in lower case (cut where they are too long for one), whether there is a place between words."""
    words = _BETWEEN.split(value.lower())
    return len(value), Counter(value), value[:1], any(map(_placeholder, words[1:-1])), words[0][: _LONGEST + 1], words[-1][: _LONGEST + 1], len(words) > 1


def _joined_facts(every: list[tuple]) -> tuple:
    """The facts of a concatenation, from those of its parts."""
    counts, first, placeholder, head, tail, several = Counter(), "", False, "", "", False
    for _, c, f, p, h, t, more in every:
        counts.update(c)
        first, meets = first or f, (tail + h)[: _LONGEST + 1]
        placeholder = placeholder or p or several and more and _placeholder(meets)
        head = head if several else meets
        tail, several = t if more else meets, several or more
    n = sum(counts.values())
    if n > 1 << 256:  # a constant joined to itself again and again: shares of characters are all that counts
        counts = Counter({c: max(1, k >> 128) for c, k in counts.items()})
        n = sum(counts.values())
    return n, counts, first, placeholder, head, tail, several


def _facts_of(text: str, value: _Value) -> tuple:
    """The facts of a value; each value below it is looked at once, and none recursively."""
    todo = [value]
    while todo:
        v = todo[-1]
        below = [p for p in v.parts if isinstance(p, _Value) and p.facts is None] if v.facts is None else []
        if below:
            todo += below
            continue
        todo.pop()
        if v.facts is None:
            every = [p.facts if isinstance(p, _Value) else _facts(text[p[0] : p[1]]) for p in v.parts]
            v.facts = every[0] if len(every) == 1 else _joined_facts(every)
    return value.facts


def _score(facts: tuple) -> float:
    n, counts, first, placeholder, head, tail, _ = facts
    if n < 8 or " " in counts or first in "$<{%" or placeholder or _placeholder(head) or _placeholder(tail):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    chars = "".join(counts)
    classes = sum(bool(re.search(p, chars)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, max(0.0, (entropy - 2.0) / 1.2)) * (1.0 if classes >= 2 else 0.6)


def value_score(value: str) -> float:
    """0 to 1: how much a literal looks like key material: length, entropy, no placeholder, no template."""
    return _score(_facts(value))


def _logical_lines(text: str) -> Iterator[tuple[int, int]]:
    """Where lines begin and end; lines that a value goes on over are one."""
    at, n = 0, len(text)
    while at <= n:
        stop = text.find("\n", at)
        stop = n if stop < 0 else stop
        begin = at
        while stop < n:
            if _OPENS.search(text, begin, stop):
                while stop < n:  # lines of literals only, up to the one that closes
                    end = text.find("\n", stop + 1)
                    end = n if end < 0 else end
                    got = _LITERALS.match(text, stop + 1, end)
                    if not got.group(1) and got.end() < end:
                        break
                    stop = end
                    if got.group(1):
                        break
                break
            if not _GOES_ON.search(text, max(begin, stop - 200), stop):
                break
            begin = stop + 1
            stop = text.find("\n", begin)
            stop = n if stop < 0 else stop
        yield at, stop
        at = stop + 1


def _blocks(text: str) -> list[tuple[int, str, tuple]]:
    """Names whose value is a block of lines: where they stand, the name and the lines that hold no blank."""
    found = [(m.start(1), m.group(1), m.span(3)) for m in _TRIPLE.finditer(text)] if '"""' in text or "'''" in text else []
    found += [(m.start(2), m.group(2), m.span(3)) for m in _BLOCK.finditer(text)] if "|" in text or ">" in text else []
    out = []
    for at, name, (a, b) in sorted(found):
        lines = [(a + m.start(), a + m.end()) for m in re.finditer(r"(?<!\S)\S+(?=[ \t\r]*(?:\n|\Z))", text[a:b])]
        out.append((at, name, tuple(x for x in lines if not text[text.rfind("\n", a, x[0]) + 1 if "\n" in text[a : x[0]] else a : x[0]].strip())))
    return out


def _unquoted(text: str, start: int, stop: int, strings: dict[int, int], constants: dict[str, _Value]) -> int:
    """The end of an unquoted value: white space, a delimiter, or what joins it to a literal that follows."""
    end = start
    while True:
        end = _RUN.match(text, end, stop).end()
        if end == stop or text[end] not in "\"'`" or end in strings:
            break
        end += 1  # a quote that no other closes
    if end in strings:
        end -= len(_JOINT.search(text[max(start, end - 3) : end]).group())
    elif end - 1 > start and text[end - 1] == "+":
        after = _BLANK.match(text, end, stop).end()
        word = _LEAD.match(text, after, stop)
        if after in strings or word and word.group() in constants or text[start : end - 1] in constants:
            end -= 1
    return end


def literal_spans(text: str, least: float = 0.5) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, by assignment, reference or concatenation.

    An unquoted value is one run of characters up to white space, a comma, a semicolon, a bracket or a quoted literal.
    A value may follow on the next line, go on over lines in parentheses or after ``+``, or be a block: a triple-quoted
    literal or the indented lines under ``|`` or ``>``. A subscript is a name; a name may get its value after its use.
    Constants keep all their parts, by reference: a value's facts and spans are worked out once for all that use it.
    """
    constants: dict[str, _Value] = {}
    longest = 0
    found: set[tuple[int, int]] = set()
    blocks = _blocks(text)[::-1]
    alias: dict[str, str] = {}  # names whose value is a name that isn't known yet
    late: list[tuple[str, float]] = []  # such names, by the weight of what they reach

    def reach(value: _Value, weight: float) -> None:
        if weight and weight * _score(_facts_of(text, value)) >= least:
            _take(value, found)

    for at, stop in _logical_lines(text):
        while blocks and blocks[-1][0] < stop:
            _, name, parts = blocks.pop()
            if parts:
                constants[name] = _Value(parts)
                longest = max(longest, len(name))
                reach(constants[name], name_score(name))
        line = text[at:stop]
        if "=" in line or ":" in line:
            tokens = [(m.lastgroup, m.start() + at, m.end() + at, m.group()) for m in _TOKEN.finditer(line)]
            strings = {start: end for kind, start, end, _ in tokens if kind == "string"}
            run_end, last_cut, rests = at, at, {}
            i = 0
            while i + 2 <= len(tokens):
                kind, _, _, name = tokens[i]
                if kind == "end" and name == "]" and i > 1 and tokens[i - 1][0] == "string" and tokens[i - 2][3] == "[":
                    kind, name = "string", tokens[i - 1][3]  # a subscript is a name
                if kind not in ("word", "string") or i + 1 >= len(tokens) or tokens[i + 1][0] != "op" or tokens[i + 1][3] == "==":
                    i += 1
                    continue
                name, parts, refers, j, pos, inner = name.strip("\"'`"), [], [], i + 2, tokens[i + 1][2], False
                alias.pop(name, None)
                start = _BLANK.match(text, pos, stop).end()
                if within := start < stop and text[start] == "(" and (start + 1 == stop or text[start + 1] in " \t\r\n\"'"):
                    pos = start + 1
                while True:
                    start = _BLANK.match(text, pos, stop).end()
                    if start in strings:
                        parts.append((start + 1, strings[start] - 1))
                        pos = strings[start]
                    elif start == stop or text[start] in ",;{}()[]" or text[start] == "#" and start > pos:
                        break
                    else:
                        if start >= run_end or start not in rests:
                            run_end = _unquoted(text, start, stop, strings, constants)
                            if run_end == start:
                                break
                            # Names within the run have its rest as their value; rests share what they have in common.
                            while j < len(tokens) and tokens[j][1] < start:
                                j += 1
                            k, cuts = j, [start]
                            while k < len(tokens) and tokens[k][1] < run_end:
                                if tokens[k][0] == "op" and start < tokens[k][2] < run_end:
                                    cuts.append(tokens[k][2])
                                k += 1
                            last_cut, rests, rest = cuts[-1], {}, None
                            for x, y in zip(reversed(cuts), reversed([*cuts[1:], run_end])):
                                rest = rests[x] = _Value(((x, y), rest) if rest else ((x, y),))
                        inner = start < last_cut
                        pos = run_end
                        whole = text[start:pos] if pos - start <= longest else None
                        lead = _LEAD.match(text, start, pos)
                        if whole in constants:
                            parts.append(constants[whole])
                        elif not inner and "+" in (run := text[start:pos]) and any(p in constants for p in run.split("+")):
                            for p in run.split("+"):
                                parts.append(constants[p] if p in constants else (start, start + len(p)))
                                start += len(p) + 1
                        else:
                            parts.append(rests[start])
                            if lead and lead.end() == pos and not inner and len(parts) == 1:
                                alias[name] = lead.group()
                                late.append((lead.group(), name_score(name)))
                            if lead and lead.group() in constants:  # a reference with something after it, or a secret that starts like one
                                refers.append(constants[lead.group()])
                        if inner:
                            break
                        if pos in strings and text[pos - 1] not in "=:>+":  # a literal with a prefix
                            continue
                    plus = _BLANK.match(text, pos, stop).end()
                    if within and (plus in strings or plus + 1 < stop and plus + 1 in strings):
                        pos = plus  # literals in parentheses need no sign between them
                        continue
                    if plus >= stop or text[plus] != "+":
                        break
                    pos = plus + 1
                if parts:
                    # A literal keeps its own place when a constant carries it on.
                    value = _Value(tuple(parts))
                    weight = name_score(name)
                    for v in (value, _Value(tuple(refers)) if refers else None):
                        if v:
                            reach(v, weight)
                    constants[name] = _Value((*refers, value)) if refers else value
                    longest = max(longest, len(name))
                    while not inner and j < len(tokens) and tokens[j][1] < pos:
                        j += 1
                i = j if parts and not inner and not (j < len(tokens) and tokens[j][0] == "op") else i + 1
    # Names that were given their value after they were used, through other such names too.
    ends: dict[str, str] = {}
    for name, weight in late:
        if weight:
            path = []
            while name in alias and name not in ends and alias[name] != name and len(path) <= len(alias):
                path.append(name)
                name = alias[name]
            name = ends.get(name, name)
            ends.update(dict.fromkeys(path, name))
            if name in constants and name not in alias:
                reach(constants[name], weight)
    # Pieces of one run are one span.
    spans: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if spans and spans[-1][1] >= a:
            spans[-1] = (spans[-1][0], max(spans[-1][1], b))
        else:
            spans.append((a, b))
    return spans


def _take(value: _Value, found: set[tuple[int, int]]) -> None:
    """Adds all spans of a value; what has been added has no parts any more."""
    todo = [value]
    while todo:
        v = todo.pop()
        for p in v.parts:
            if isinstance(p, _Value):
                todo.append(p)
            elif p[1] > p[0]:
                found.add(p)
        v.parts = ()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    if _KEYWORD.search(text):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [(*m.span(), "access") for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def spans_of(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans and those that the method adds; an added span may overlap base spans but is not inside one."""
    if not text:
        return [], []
    base, added = base_spans(text), []
    if "=" in text or ":" in text:
        i, reach = 0, -1
        for a, b in literal_spans(text):
            while i < len(base) and base[i][0] <= a:
                i, reach = i + 1, max(reach, base[i][1])
            if b > reach:  # not inside a base span
                added.append((a, b, "literal"))
    return base, added


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_assign, n_access, n_hex, n_literal, base_sha256, spans)."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base, added = spans_of(text)
                n = Counter(k for *_, k in base)
                every = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))
                out.append((n["assign"], n["access"], n["hex"], len(added), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])], ["doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"])

    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, base_sha256 string, spans string")


def redacted(text: str | None) -> str | None:
    """The text with every span's secret replaced; overlapping spans are replaced as one."""
    if not text:
        return text
    base, added = spans_of(text)
    out, at = [], 0
    for s, e, _ in sorted(base + added):
        if s >= at:
            out += [text[at:s], "[REDACTED]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same rows and columns; secrets in the text are replaced, and a column that holds its length follows."""
    small_batches(docs.sparkSession)
    k = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([redacted(t) for t in batch.column(k).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == k else c for i, c in enumerate(batch.columns)], batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.select(*(F.coalesce(F.length(text_col).cast(kind), c).alias(c) if c == length_col else c for c in docs.columns))
    return out


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
