"""Secret scans: pattern matches plus dictionary-primed zstandard novelty.

Base spans come from three fixed patterns. The method adds a span for each
token in a sensitive context that is not yet covered and that zstandard cannot
predict. A token is in a sensitive context if it stands near a sensitive word
(before, after or around it), if it belongs to a run (dot-separated parts,
consecutive lines) that does, or if it is in a BEGIN ... KEY block, which stays
open until its END line. Tokens have at least 12 characters (a shorter last line
of a key goes with the line before it); which of them are reported is decided by
the compressed bytes alone, with or without digits. The compressor is primed with a dictionary of common identifiers, the
code around the token is compressed once without and once with the token, and
the difference in bytes is the token's novelty. A random key costs nearly its
entropy; a word, a repeated name or a path already seen nearby costs a few
bytes.

Spans are code points, end exclusive. Defined results: NULL and empty texts
have no spans; repeated rows give repeated rows; whole texts are scanned.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from daybook.llm.common import col, map_rows, map_texts

# The base patterns, their kinds and the lengths they must reach.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # = runs of [0-9a-f] of 32 or more: shorter runs are skipped whole
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "novel")

# Words that make a context sensitive, and identifiers that are no news in code.
SENSITIVE = re.compile(
    r"passw|passphrase|pwd|secret|token|api.?key|access.?key|private.?key|auth|bearer|credential|signature|license.?key",
    re.I | re.A,
)
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}={0,2}")  # whole runs only
# What may stand between the lines of one key, and a last line that is shorter than a candidate.
BETWEEN = re.compile(r"""[\s"'`,;#*>|+/\\]*+""")
SHORT = re.compile(
    r"""([\s"'`,;#*>|\\]*+(?:(?://|\+)\s[\s"'`\\]*+)?)([A-Za-z0-9+/_-]{1,11}={0,2})(?![A-Za-z0-9+/_=-])"""
)
MARK = re.compile(r"-{4,5}\x20?(BEGIN|END)\x20([A-Z0-9\x20]++)-{4,5}")
BODY = re.compile(r"[A-Za-z0-9+/=]*|[A-Za-z0-9-]+:\x20.*")  # lines of a key block that lacks its END line
IDENTIFIERS = (
    "def class return import from self None True False public private static final void string int float "
    "const function var let async await export default module require config settings environment variable "
    "username user_id account password passwd secret token api_key apikey access_key secret_key private_key "
    "client_id client_secret authorization bearer basic signature credential session cookie header content-type "
    "application/json http https localhost example test sample placeholder changeme your_token_here "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx 0000000000000000 "
)
# Parts of long words and names: what is put together from them is no news either.
PARTS = (
    "ation ational ization ific fication ication ement ments ability ibility ously ingly ness less ance ence ental ential "
    "ating ified ition inter national under over super multi trans repres present respons require process program perform "
    "property parameter configur document develop environ implement initial instance register relation resource structure "
    "subscri descript distribut construct connect control compon comput complete compat commun combin collect character "
    "certific authent author attribut associat assign argument applicat another alternat access abstract valid unknown "
    "undefin unexpect transfer timeout template synchron support success string standard specif special source socket "
    "single signat separat select section schedule restrict request report remov refer recogn receiv random provid protocol "
    "prefix prepar pattern password option operat object number normal message method maximum minimum manage locat length "
    "languag iterat internal interfac integr inform include ignore identif handler general generat function format filename "
    "extens express except exist execut establish error encrypt encod element dynamic download director different dictionar "
    "detect destinat depend default decrypt decod databas current creat content contain condition command client check "
    "change callback buffer build available automat archive "
    "Get Set Is Has Test Token Key Type Name Value Error Exception Handler Auth Access Secret Service Server Client Request "
    "Response User Data File Code Manager Factory Provider Config Controller Builder Parser Session Message Default "
    "TEST TOKEN KEY TYPE NAME VALUE ERROR EXCEPTION DEFAULT GLOBAL TIMEOUT MAX MIN LENGTH SIZE ALL ACCESS AUTH PASSWORD "
    "SECRET UNKNOWN FORMAT MESSAGE METHOD NAMES COUNT DUMP "
    "authentication authorization authenticated unauthorized representation configuration implementation documentation "
    "application administrator communication verification certificate specification notification registration "
    "subscription organization international infrastructure permissions credentials requirements relationship "
    "distribution installation initialization serialization development environments alternatively automatically "
    "successfully particularly unfortunately responsibility corresponding understanding characteristics "
    "parameters transactions cryptography cryptographic "
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base patterns, by start, then kind as listed."""
    found = [
        (m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8
    ]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict((PARTS + IDENTIFIERS).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(
        level=19, dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def compressed(text: str) -> int:
    return len(_compressor().compress(text.encode()))


def novelty(token: str, around: str) -> int:
    """Bytes that ``token`` adds to the compressed form of the code ``around`` it.

    The token follows a copy of its surroundings, so what it repeats from
    there or from the identifier dictionary costs only a back-reference.
    """
    return compressed(around + token) - compressed(around)


def key_blocks(text: str) -> list[tuple[int, int]]:
    """What lies between the BEGIN and END lines of keys that are not public.

    A block without an END line reaches as far as its lines look like a key's.
    """
    found, at = [], -1
    marks = [(m.start(), m.end(), m[1] == "BEGIN" and "KEY" in m[2] and "PUBLIC" not in m[2], m[1]) for m in MARK.finditer(text)]
    for start, end, opens, name in [*marks, (len(text), len(text), False, "")]:
        if at >= 0:
            stop = start
            if name != "END":
                stop = at
                for line in text[at:start].splitlines(keepends=True):
                    if not BODY.fullmatch(line.strip()):
                        break
                    stop += len(line)
            if at < stop:
                found.append((at, stop))
        at = end if opens else -1
    return found


def broken(gap: str) -> bool:
    """Whether ``gap`` holds a line break, also an escaped one."""
    return "\n" in gap or "\\" in gap


def runs(text: str, blocks: list[tuple[int, int]]) -> list[tuple[list[tuple[int, int]], int]]:
    """Candidates, each with those that a dot, line breaks or a key block bind it to; and the end of that block or -1."""

    def joined(start: int, end: int) -> bool:
        gap = text[start:end]
        return gap == "." or (broken(gap) and BETWEEN.fullmatch(gap) is not None)

    found: list[tuple[list[tuple[int, int]], int]] = []
    i = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while i < len(blocks) and blocks[i][1] <= start:
            i += 1
        block = i if i < len(blocks) and blocks[i][0] < end else -1
        if found and found[-1][1] == block and (block >= 0 or joined(found[-1][0][-1][1], start)):
            found[-1][0].append((start, end))
        else:
            found.append(([(start, end)], block))
    return [(tokens, blocks[block][1] if block >= 0 else -1) for tokens, block in found]


def novel_spans(
    text: str, taken: list[tuple[int, int, str]], reach: int, around: int, least_bytes: int, least_ratio: float
) -> list[tuple[int, int, str]]:
    """Tokens in a sensitive context (a word within ``reach`` code points, or a key block) that do not compress.

    Novelty is measured against what surrounds a token's run, so the lines of one key do not vouch for each other.
    """
    words = [m.span() for m in SENSITIVE.finditer(text)]
    blocks = key_blocks(text)
    if not words and not blocks:
        return []
    word_ends = [e for _, e in words]

    def near_word(start: int, end: int, outside: bool = False) -> bool:
        i = bisect_left(word_ends, start - reach)
        if not outside:
            return i < len(words) and words[i][0] <= end + reach
        if i < len(words) and words[i][1] <= start:
            return True
        i = bisect_left(words, (end,))
        return i < len(words) and words[i][0] <= end + reach

    found = []
    ends: list[int] = []  # running maximum of the taken spans' ends, by start
    for _, e, _ in taken:
        ends.append(max(e, ends[-1]) if ends else e)
    starts = [s for s, _, _ in taken]

    def covered(start: int, end: int) -> bool:
        i = bisect_right(starts, end - 1)
        return bool(i) and ends[i - 1] > start

    for tokens, block_end in runs(text, blocks):
        first, last = tokens[0][0], tokens[-1][1]
        # A word inside a run may be chance: it speaks for the tokens near it only.
        whole = block_end >= 0 or near_word(first, last, outside=True)
        near, alone = "", -1
        for start, end in tokens:
            if not (whole or near_word(start, end)):
                continue
            token = text[start:end]
            hit = covered(start, end)
            if not hit:
                if alone < 0:
                    near = text[max(0, first - around) : first] + " " + text[last : last + around]
                    alone = compressed(near)
                cost = compressed(near + token) - alone
                hit = cost >= least_bytes and cost >= least_ratio * len(token)
                if hit:
                    found.append((start, end, "novel"))
            # The last line of a key may be shorter than a candidate.
            m = SHORT.match(text, end) if hit else None
            if m and broken(m[1]) and (m.end() <= block_end or m[2].endswith("=")) and not covered(*m.span(2)):
                found.append((*m.span(2), "novel"))
    return found


def secret_spans(
    text: str | None, reach: int = 48, around: int = 256, least_bytes: int = 10, least_ratio: float = 0.7
) -> list[tuple[int, int, str]]:
    """Base and added spans of one text, by start, then kind.

    ``around`` is the amount of neighbouring code that a candidate's novelty
    is measured against on either side; the scan itself covers the whole text.
    """
    if not text:
        return []
    base = base_spans(text)
    more = novel_spans(text, base, reach, around, least_bytes, least_ratio)
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every covered run of code points replaced by ``mark``."""
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, counts of base spans, their digest, all spans and the count of added ones."""

    def work(ids: list, texts: list) -> list:
        spans = [secret_spans(t) for t in texts]
        base = [[s for s in x if s[2] != "novel"] for x in spans]
        counts = [[sum(s[2] == k for s in x) for x in spans] for k in KINDS]
        digest = [hashlib.sha256(joined(x).encode()).hexdigest() for x in base]
        return [ids, *counts[:3], digest, [joined(x) for x in spans], counts[3]]

    narrow = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    fields = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"
    return map_texts(narrow, work, fields)


def redact_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced and ``length`` brought up to date; rows and columns stay.

    Only texts that hold a secret change; NULL stays NULL.
    """
    others = [c for c in docs.columns if c != text]
    i_len = others.index(length) + 1 if length in others else None

    def run(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            spans = [secret_spans(t) for t in texts]
            columns = list(b.columns)
            if any(spans):
                new = [redacted(t, s) if s else t for t, s in zip(texts, spans)]
                columns[0] = pa.array(new, type=b.column(0).type)
                if i_len is not None:
                    sizes = [len(t) if s else n for t, s, n in zip(new, spans, columns[i_len].to_pylist())]
                    columns[i_len] = pa.array(sizes, type=columns[i_len].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return map_rows(docs, text, run)
