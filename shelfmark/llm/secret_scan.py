"""Secret scan by assignment-aware lexing.

A text is read as source or configuration syntax. Wherever a name stands before ``=``, ``:``, ``:=`` or ``=>`` (quoted names,
XML attributes and command-line flags too), or an XML element encloses a value, what follows is lexed: strings with escapes,
prefixes and triple quotes, strings joined by ``+``, ``.`` or by standing together, calls, bare words, references to other
names, YAML blocks, and comments, which end a value. Each becomes a name-literal pair.

Constants are propagated: a name stands for the literal that the nearest assignment before it gave it in the same block or one
around it (by indentation), or else for one that an outermost assignment gives it later; ``b = a``, ``"${a}x"``, ``f"{a}"`` and
chains of these are followed however long (but see ``EXPANSION``). A call has no literal of its own, but for one that only wraps a string and for the default of an
environment lookup. Each literal is scored by how sensitive its target name is and by how random the literal looks. Pairs
that score ``threshold`` or more add the spans ``pair`` (the value as written) and ``source`` (the literal that a propagated
constant came from).

Below the method lies a fixed base of three patterns (``assign``, ``access``, ``hex``) whose spans are always kept.
Positions are code points, ends are exclusive. A text is passed over once however long its lines are; names, values and
elements may have any length (an indentation of over 200 counts as 200). A null text counts as empty and has no spans; a null
``doc_id`` stays null; repeated rows are each scanned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.common import read, texts

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex")

#: A name and what binds a value to it. No word is tried twice: a name starts where no name can go on.
_BOUND = re.compile(r"""(?<![A-Za-z0-9_$.])([A-Za-z_$][A-Za-z0-9_$.-]*)(["'`]?\]?)[ \t]*(?::=|=>|(?<![=!<>+*/%&|^-])=(?![=>~])|:(?![:/=\\]))""")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)(?:[ \t][^<>\n]*)?>([^<>\n]+)</\1>")
_KEYED = re.compile(r"""(?:key|name)[ \t]*=[ \t]*"([^"\n]+)"[ \t]+value[ \t]*=[ \t]*("[^"\n]*")""")
_FLAG = re.compile(r"""(?<![\w-])--?([a-z][a-z0-9-]{2,})[ \t]+("[^"\n]+"|'[^'\n]+'|[^\s"'-][^\s]*)""")
_USERINFO = re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]+:([^\s:/@]+)@")
_STRING = re.compile(
    r"""[rRbBfFuU]{0,2}(?:\"""(?:[^"\\]|\\.|"(?!""))*\"""|'''(?:[^'\\]|\\.|'(?!''))*'''|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`)""", re.DOTALL
)
_NAME = re.compile(r"\$?\{?([A-Za-z_$][A-Za-z0-9_$.]*)\}?")
_BARE = re.compile(r"""[^\s,;"'`<>(){}\[\]#]+""")
_GLUE = re.compile(r"[ \t]*(?:\\\n[ \t]*)?(?:\+|\.(?=[ \t]*[\"'$])|)[ \t]*(?:\\\n[ \t]*)?")
_BLANK = re.compile(r"[ \t]*(?:\\\n[ \t]*)?")
_BLOCK = re.compile(r"[|>][+-]?[ \t]*\n((?:[ \t]+[^\n]*\n?)+)")
_CALL = re.compile(r"[ \t]*\([ \t]*")
_ENVIRONMENT = re.compile(r"(?:^|\.)(?:getenv|get|env|environ|getProperty|getOrDefault)\Z")
_WRAPPER = {"str", "bytes", "String", "string", "Secret", "SecretStr", "SecureString", "b64decode", "base64.b64decode", "decode", "bytearray", "quote", "new"}
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_MENTION = re.compile(r"\$\{([A-Za-z_][\w.]*)\}|\$([A-Za-z_]\w*)|\{([A-Za-z_][\w.]*)\}|%\(([A-Za-z_]\w*)\)s")
_SCHEME = re.compile(r"(?:Bearer|Basic|Token|Digest)[ \t]+", re.IGNORECASE)
#: A bare word may hold names and values itself (a URL's query); see ``value_at``.
TAIL = 4096
#: References of a text are followed while what they expand to is no more than this many times the text (and ``ROOM``
#: characters): constants that double each other would have no end.
EXPANSION, ROOM = 16, 100_000

#: How much each part of a name says that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 0.8, "passphrase": 1.0, "secret": 1.0, "credential": 0.9, "credentials": 0.9,
    "token": 0.9, "apikey": 1.0, "private": 0.6, "auth": 0.6, "authorization": 0.8, "bearer": 0.8, "signing": 0.5, "access": 0.4, "api": 0.4,
    "client": 0.2, "key": 0.4, "salt": 0.5, "session": 0.3, "encryption": 0.5, "master": 0.3, "pin": 0.5, "otp": 0.6, "cookie": 0.4, "signature": 0.4,
}
#: Last parts of names that say what about a secret is meant, so that it is none; parts that make a key an ordinary one.
ABOUT = {
    "count", "length", "len", "size", "limit", "type", "name", "names", "id", "ids", "url", "uri", "path", "file", "field", "column", "policy", "format", "hint", "label",
    "prompt", "index", "version", "max", "min", "enabled", "required", "reset", "expiry", "ttl", "timeout", "rotation", "usage", "budget", "rate", "list", "provider",
}
ORDINARY = {"primary", "foreign", "public", "sort", "partition", "cache", "unique", "row", "object", "map", "dict", "sorting", "hot", "shortcut", "piano", "answer"}
PLACEHOLDERS = {"changeme", "example", "password", "secret", "token", "none", "null", "true", "false", "undefined", "redacted", "placeholder"}
_PLACEHOLDER = re.compile(r"(?:x{4,}|\*{3,}|\.{3,}|<[^>]*>|your[-_ ].*|.*(?:change[-_]?me|placeholder|redacted).*|\{\{.*\}\}|%[A-Z_]+%|\$\{?\w+\}?)\Z", re.IGNORECASE)
THRESHOLD = 0.6


def name_score(name: str) -> float:
    """0 to 1: the sensitivity of an assignment's target."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or parts[-1] in ABOUT or (parts[-1] in ("key", "keys") and ORDINARY & set(parts)):
        return 0.0
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in set(parts)))


def literal_score(literal: str) -> float:
    """0 to 1: length, entropy and mix of characters of a literal."""
    n = len(literal)
    if n < 6 or literal.lower() in PLACEHOLDERS or len(set(literal)) < 4 or _PLACEHOLDER.match(literal):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    classes = sum(any(f(c) for c in literal) for f in (str.islower, str.isupper, str.isdigit)) + (not literal.isalnum())
    spaces = literal.count(" ")
    score = min(1.0, n / 20) * 0.4 + min(1.0, entropy / 4) * 0.4 + min(1.0, (classes - 1) / 2) * 0.2
    # words in a row are prose or a passphrase, not random
    return score * (0.4 if spaces > 4 else 0.7 if spaces else 1.0)


class Value:
    """What stands after a name: its span, and its terms: ``(literal, start, end)``, or ``(None, name, place)`` of a reference."""

    def __init__(self, start: int, end: int, terms: list[tuple], bare: int = 0):
        #: ``bare`` is where the bare word ends that the value is, or is a part of.
        self.start, self.end, self.terms, self.bare = start, end, terms, bare


def _unquoted(raw: str) -> str:
    body = raw.lstrip("rRbBfFuU") if raw[0] not in "\"'`" else raw
    n = 3 if body[:3] in ('"""', "'''") and len(body) >= 6 else 1
    return body[n:-n].replace('\\"', '"').replace("\\'", "'").replace("\\\\", "\\")


def _term(text: str, at: int) -> tuple[int, tuple] | None:
    """The term at a place and its end."""
    if m := _STRING.match(text, at):
        return m.end(), (_unquoted(m[0]), at, m.end())
    m = _NAME.match(text, at)
    if not m:
        return None
    called = _CALL.match(text, m.end())
    if called and m[0][0] != "$":
        inner = _STRING.match(text, called.end())
        if not inner:
            return None
        after = _BLANK.match(text, inner.end()).end()
        if text[after : after + 1] == ")" and m[1] in _WRAPPER:
            return after + 1, (_unquoted(inner[0]), inner.start(), inner.end())
        if text[after : after + 1] == "," and _ENVIRONMENT.search(m[1]):
            default = _STRING.match(text, _BLANK.match(text, after + 1).end())
            if default:
                return default.end(), (_unquoted(default[0]), default.start(), default.end())
        return None
    return m.end(), (None, m[1], at)


def value_at(text: str, at: int, within: int = 0, until: int = 0) -> Value | None:
    """Lexes the value at a place. ``within``: the end of the bare word that the place is in, if it is in one; a value of
    more than ``TAIL`` characters there ends before ``until``, the next name in it, or before an ``&``."""
    at = _BLANK.match(text, at).end()
    if block := _BLOCK.match(text, at):
        body = "".join(line.strip() for line in block[1].splitlines())
        return Value(block.start(1), block.end(1), [(body, block.start(1), block.end(1))])
    if scheme := _SCHEME.match(text, at):
        at = scheme.end()
    first = _term(text, at)
    if at < within:
        bare = within
    else:
        found = _BARE.match(text, at)
        bare = found.end() if found else at
    if first is None or (first[1][0] is None and bare > first[0]):
        # a bare word that is no name: numbers, paths, base64
        if bare > at and not _CALL.match(text, bare):
            end = bare
            if at < within and bare - at > TAIL:
                end = min(bare, max(until, at))
                mark = text.find("&", at, end)
                end = mark if mark >= 0 else end
            return Value(at, end, [(text[at:end].rstrip(".,:"), at, end)], bare)
        return None
    end, terms = first[0], [first[1]]
    while True:
        glue = _GLUE.match(text, end)
        more = _term(text, glue.end()) if glue.end() > end or text[end : end + 1] in "\"'" else None
        # words that only stand together are prose; strings are one literal
        if more is None or (not glue[0].strip(" \t\\\n") and (more[1][0] is None or terms[-1][0] is None)):
            break
        end = more[0]
        terms.append(more[1])
    return Value(at, end, terms)


class Definition:
    """One assignment: where, how deep its line is indented, and from where on a line less indented has closed its block."""

    def __init__(self, name: str, value: Value, place: int, depth: int):
        self.name, self.value, self.place, self.depth, self.closed = name, value, place, depth, 1 << 62


def assignments(text: str) -> list[Definition]:
    """All assignments in the order of the text."""
    found: list[Definition] = []
    line_end, depth, commented = -1, 0, False
    open_: list[Definition] = []
    bound, within = list(_BOUND.finditer(text)), 0
    for m, then in zip(bound, [*(b.start() for b in bound), len(text)][1:], strict=True):
        if m.start() > line_end:
            line_start = text.rfind("\n", 0, m.start()) + 1
            line_end = text.find("\n", m.start())
            line_end = len(text) if line_end < 0 else line_end
            head = text[line_start : min(m.start(), line_start + 200)]
            depth = len(head) - len(head.lstrip(" \t"))
            commented = head.lstrip().startswith(("#", "//", "*", "--", ";"))
            while open_ and open_[-1].depth > depth:
                open_.pop().closed = m.start()
        value = value_at(text, m.end(), within, then)
        if value is not None:
            within = max(within, value.bare)
            found.append(Definition(m[1], value, m.start(), depth))
            if commented:  # what a comment assigns is no constant
                found[-1].closed = m.start()
            else:
                open_.append(found[-1])
    for pattern in (_ELEMENT, _KEYED, _FLAG, _USERINFO) if ("<" in text or "--" in text or "://" in text or "value" in text) else ():
        for m in pattern.finditer(text):
            name, at = (m[1], 2) if pattern is not _USERINFO else ("password", 1)
            raw = m[at]
            literal = _unquoted(raw) if raw[0] in "\"'" and raw[-1] == raw[0] and len(raw) > 1 else raw.strip()
            found.append(Definition(name, Value(*m.span(at), [(literal, *m.span(at))]), m.start(), 0))
            found[-1].closed = m.start()
    return sorted(found, key=lambda d: d.place)


class Constants:
    """Looks names up as a reader would: the nearest definition before, in a block that is still open; or an outermost one.

    Definitions are kept by name and depth. Of one depth only the last before a place has to be asked: a line that closes it
    has closed those before it too.
    """

    def __init__(self, found: list[Definition], size: int):
        self.of: dict[str, dict[int, list[Definition]]] = {}
        for d in found:
            if d.closed > d.place:
                self.of.setdefault(d.name, {}).setdefault(d.depth, []).append(d)
        self.solved: dict[int, tuple[str, list[tuple[int, int]]] | None] = {}
        self.room = EXPANSION * size + ROOM

    def definition(self, name: str, place: int, depth: int) -> Definition | None:
        levels = self.of.get(name) or self.of.get(name.rsplit(".", 1)[-1]) or {}
        best = None
        for level, every in levels.items():
            i = bisect_left(every, place, key=lambda d: d.place) - 1
            if level <= depth and i >= 0 and every[i].closed > place and (best is None or every[i].place > best.place):
                best = every[i]
        if best is None and 0 in levels:
            i = bisect_right(levels[0], place, key=lambda d: d.place)
            best = levels[0][i] if i < len(levels[0]) else None
        return best

    def _pieces(self, d: Definition) -> list[tuple[str, Definition | None]]:
        """What a value is put together from: text, or a definition and the text that stands where it has no literal."""
        out: list[tuple[str, Definition | None]] = []
        for term in d.value.terms:
            if term[0] is None:
                # a bare word that names nothing is a literal of configuration
                out.append((term[1], self._other(term[1], d)))
                continue
            body, at = term[0], 0
            for m in _MENTION.finditer(body) if "$" in body or "{" in body or "%(" in body else ():
                # what is not known is no part of the literal
                out += [(body[at : m.start()], None), ("", self._other(m[1] or m[2] or m[3] or m[4], d))]
                at = m.end()
            out.append((body[at:], None))
        return out

    def _other(self, name: str, d: Definition) -> Definition | None:
        target = self.definition(name, d.place, d.depth)
        return None if target is d else target

    def literal(self, d: Definition) -> tuple[str, list[tuple[int, int]]] | None:
        """The literal that a definition's value stands for, and where its parts were written elsewhere; a definition that
        leads back to one being solved is not known to it."""
        pieces: dict[int, list[tuple[str, Definition | None]]] = {}
        stack = [d]
        while stack:
            top = stack[-1]
            if id(top) in self.solved:
                stack.pop()
            elif id(top) not in pieces:
                pieces[id(top)] = self._pieces(top)
                stack += [x for _, x in pieces[id(top)] if x is not None and id(x) not in self.solved and id(x) not in pieces]
            else:
                self.solved[id(stack.pop())] = self._joined(pieces.pop(id(top)))
        return self.solved[id(d)]

    def _joined(self, pieces: list[tuple[str, Definition | None]]) -> tuple[str, list[tuple[int, int]]] | None:
        out: list[str] = []
        sources: dict[tuple[int, int], None] = {}
        for text, target in pieces:
            inner = self.solved.get(id(target)) if target is not None else None
            out.append(text if inner is None else inner[0])
            if inner is not None:
                sources.update(dict.fromkeys(inner[1] or [(target.value.start, target.value.end)]))
        cost = (sum(map(len, out)) if len(out) > 1 else 0) + (len(sources) if len(sources) > 1 else 0)
        self.room -= cost
        return None if cost and self.room < 0 else ("".join(out), list(sources))


def pairs(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the assignments whose target name and literal look secret."""
    if not _ANY_SENSITIVE.search(text) and "://" not in text:
        return []
    found: set[tuple[str, int, int]] = set()
    every = assignments(text)
    constants = Constants(every, len(text))
    for d in every:
        sensitive = name_score(d.name)
        # a lone reference that names nothing is code, unless it looks random
        if not sensitive or (solved := constants.literal(d)) is None:
            continue
        literal, sources = solved
        score = literal_score(literal)
        if len(d.value.terms) == 1 and d.value.terms[0][0] is None and not sources and not any(c.isdigit() for c in literal):
            continue
        if score >= 0.4 and (sensitive + score) / 2 >= threshold:
            found.add(("pair", d.value.start, d.value.end))
            found.update(("source", *s) for s in sources if s != (d.value.start, d.value.end))
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


#: A text without any of these has no name that is sensitive enough.
_ANY_SENSITIVE = re.compile("|".join(sorted(w for w, x in SENSITIVE.items() if x > 0.2)), re.IGNORECASE)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(text: str, threshold: float = THRESHOLD) -> tuple[list, list]:
    """The base spans, and these with the method's spans."""
    base = base_spans(text)
    more = pairs(text, threshold)
    order = {k: i for i, k in enumerate((*KINDS, "pair", "source"))}
    return base, sorted({*base, *more}, key=lambda s: (s[1], order[s[0]], s[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: counts by base kind, the digest of the base spans, and all spans as text."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column("text"):
                base, spans = scan(text.as_py(), threshold)
                kinds = Counter(s[0] for s in base)
                row = (*(kinds[k] for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return texts(docs, id_col, text_col).mapInArrow(
        scanned, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``doc_id, text`` with every span replaced by ``mask``; overlapping spans are masked once."""

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                kept, at = [], 0
                for _, a, b in sorted(scan(text)[1], key=lambda s: s[1:]):
                    if a >= at:
                        kept += [text[at:a], mask]
                    at = max(at, b)
                out.append("".join([*kept, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return texts(docs, id_col, text_col).mapInArrow(cleaned, "doc_id long, text string")


def op8_secret_scan(spark, sf_dir):
    return find_secrets(read(spark, sf_dir, "documents"))
