"""Secret scans by dictionary-primed zstandard novelty.

Three patterns give the base spans.  Beyond them, a string of secret-like characters that follows a sensitive word
is a candidate, and what counts is how many bytes it adds to the compressed text around it: both are compressed with
a dictionary of common identifiers, once without and once with the candidate.  Names, paths and words repeat what is
around them or in the dictionary and cost little; random strings cost nearly a byte a character and are reported.  Strings of
letters only, or of digits only, cost less whether they are random or not, so they are held against random strings of
their own alphabet and length in the same place.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns; of a span, group 2 where there is one, else all of it, has at least so many characters.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_LEAST = 12

# Words that make what follows them sensitive, and the strings that can be secrets.
SENSITIVE = re.compile(
    r"(?:passw|passphrase|pwd|secret|token|api[ _-]?key|apikey|private[ _-]?key|access[ _-]?key|credential|bearer|authorization)", re.IGNORECASE | re.ASCII)
LEAST = 16
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_=-]{%d,}" % LEAST)
WHOLE = re.compile(r"[A-Za-z0-9+/_=-]+")
VALUE = re.compile(r"[A-Za-z0-9+/_-]{%d,}=*" % LEAST)  # of a run key=value, what stands between the equals signs
REACH = 96  # characters after a sensitive word, or a span reported behind one, in which a candidate may begin
AROUND = 1024  # characters of text on either side that the candidate is compared with
NOVELTY = 0.8  # added bytes for each character
# Without letters and digits both: the least share of what the middle one of so many random strings adds.  At 0.85, of random
# strings of 32 letters nine tenths are reported; of names made of three to five words one in twenty, or one in seven
# where none of their words stands around them or in the dictionary.
PLAIN, CONTROLS = 0.85, 3

# Common identifiers of code and configuration; a parameter of the operator.
IDENTIFIERS = (
    "import from return class self function const let var public private static void string integer boolean null None True False "
    "async await def lambda yield raise except finally package interface implements extends override namespace include define "
    "username user_name user_id password passwd secret token access_token refresh_token api_key apikey private_key public_key "
    "client_id client_secret authorization bearer credentials session cookie header request response config settings options "
    "environment variable default_value example_value placeholder changeme your_api_key_here your-secret-key localhost "
    "https://www.example.com/index.html http://localhost:8080/api/v1/users application/json content-type utf-8 "
    "get_value set_value to_string from_string parse_json read_file write_file open_connection close_connection "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef 1234567890 00000000 xxxxxxxx XXXXXXXX"
)


@functools.lru_cache(maxsize=4)
def _compressor(identifiers: str):
    import zstandard

    words = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=words, write_content_size=False)


def novelty(candidate: str, before: str, after: str, identifiers: str = IDENTIFIERS) -> float:
    """Compressed bytes that the candidate adds to the text around it, for each of its characters."""
    pack = _compressor(identifiers).compress
    around = (before + "\n" + after + "\n").encode("utf-8", "surrogatepass")
    return (len(pack(around + candidate.encode())) - len(pack(around))) / max(1, len(candidate))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points of the three patterns."""
    out = []
    low = text.lower()
    if any(x in low for x in ("passw", "secret", "token", "api")):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def _mixed(word: str) -> bool:
    return bool(re.search(r"[0-9]", word) and re.search(r"[A-Za-z]", word))


def _unlike(word: str, text: str) -> str:
    """``text`` without its other random-looking strings: those that share no four characters with ``word``.

    They repeat nothing of it, but their letters' frequencies make every random string beside them look cheaper.
    """
    grams = {word[i : i + 4] for i in range(len(word) - 3)}
    return VALUE.sub(lambda m: "" if _mixed(m[0]) and not any(m[0][i : i + 4] in grams for i in range(len(m[0]) - 3)) else m[0], text)


def _controls(word: str) -> list[str]:
    """Random strings of the word's form: letters and digits are drawn from the kinds it has, the rest stays."""
    kinds = [k for k in (string.ascii_lowercase, string.ascii_uppercase, string.digits) if set(k) & set(word)]
    alphabet = "".join(kinds)
    drawn = random.Random(len(word))
    return ["".join(drawn.choice(alphabet) if c.isalnum() else c for c in word) for _ in range(CONTROLS if alphabet else 0)]


def _is_novel(text: str, s: int, e: int, identifiers: str, around: int = AROUND) -> bool:
    word = text[s:e]
    before, after = text[max(0, s - around) : s], text[e : e + around]
    if not _mixed(word):
        controls = sorted(novelty(c, before, after, identifiers) for c in _controls(word))
        return bool(controls) and novelty(word, before, after, identifiers) >= PLAIN * controls[len(controls) // 2]
    if novelty(word, before, after, identifiers) >= NOVELTY:
        return True
    clean = _unlike(word, before), _unlike(word, after)
    return clean != (before, after) and novelty(word, *clean, identifiers) >= NOVELTY


def novel_spans(text: str, taken: list[tuple[int, int, str]], identifiers: str = IDENTIFIERS, reach_on: int = REACH, around: int = AROUND) -> list[tuple[int, int, str]]:
    """Incompressible strings in a sensitive context that no base span touches.

    A context reaches on from every span reported in it, so the lines of a key or a list are followed to their end.
    """
    out: list[tuple[int, int, str]] = []
    taken = sorted(taken)
    starts, tops = [x[0] for x in taken], list(accumulate((x[1] for x in taken), max))
    upto = reach = k = 0
    for m in SENSITIVE.finditer(text):
        upto, reach = max(m.end(), upto), max(m.end() + reach_on, reach)
        while True:
            while k < len(taken) and starts[k] <= reach:
                if taken[k][1] > m.start():
                    reach = max(reach, taken[k][1] + reach_on)
                k += 1
            c = CANDIDATE.search(text, upto, reach + LEAST)
            if not c:
                upto = max(upto, reach + 1)  # nothing begins up to there
                break
            s = c.start()
            upto = e = WHOLE.match(text, s).end()
            if text[e : e + 1] == ".":  # the next part of a token in parts
                reach = max(reach, e + 1)
            before = bisect_left(starts, e)
            if before and tops[before - 1] > s:
                continue
            values = [(v.start(), v.end()) for v in VALUE.finditer(text, s, e)]
            found = [v for v in values if _is_novel(text, *v, identifiers, around)]
            if not found and values != [(s, e)] and _is_novel(text, s, e, identifiers, around):
                found = [(s, e)]
            if found:
                out += [(*v, "novel") for v in found]
                reach = max(reach, e + reach_on)
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


def _scan(batches: Iterator[pa.RecordBatch], identifiers: str, reach: int, around: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for t in batch.column(1):
            text = t.as_py() or ""
            base = base_spans(text)
            spans = base + novel_spans(text, base, identifiers, reach, around)
            rows.append(([sum(x[2] == k for x in spans) for k in KINDS], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([r[0][i] for r in rows], pa.int64()) for i in range(4)],
             pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", identifiers: str = IDENTIFIERS,
                 reach: int = REACH, around: int = AROUND) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then kind, comma-joined; ``base_sha256`` is
    the SHA-256 of those of the three patterns.  ``reach`` is how many characters after a sensitive word, or a span
    reported behind one, a candidate may begin, ``around`` how much text on either side it is compared with.  A null or empty text has no spans.  Spans of one kind do not
    overlap; those of different kinds may, but a novel span touches no base span.  A null key stays null, repeated
    rows each get a result, other columns are ignored, an empty table gives none.
    """
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        lambda batches: _scan(batches, identifiers, reach, around),
        "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
