r"""Secret scans: fixed patterns, and novelty measured by dictionary-primed zstandard.

Patterns find assignments, access keys and long hex strings. Further
candidates are all long unbroken strings in a sensitive context: those that
start at most ``DISTANCE`` bytes after a word such as ``credential`` or
``bearer``, whatever lies between, or that go on after it. A string
``name=value`` is judged in its two parts. Nothing but novelty decides: a candidate's novelty is its marginal
size: zstandard, primed with a dictionary of identifiers and long words, compresses the
surrounding text without and with the candidate. Words and identifiers cost
little, as the dictionary or the surroundings hold their parts; a candidate
that still costs ``NOVEL`` of its length or more is incompressible and is
reported.

One pass over whole texts without a shuffle. Defined results: null is an
empty text; spans are in code points, end exclusive, over the whole match;
candidates that overlap a span found by a pattern are not reported again;
rows repeating a ``doc_id`` are judged each by its own text; other columns
are kept, except those named like the new ones.
"""

from __future__ import annotations

import bisect
import itertools
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import appended, buffer_of, map_batches, passes, with_arrays

KINDS = ("assign", "access", "hex", "novel")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
# Fixed values of the base patterns.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
# Sensitive contexts of the candidates.
CONTEXT_WORDS = (
    b"credential", b"bearer", b"passphrase", b"private", b"signing", b"signature", b"session", b"auth", b"cookie", b"pwd",
    b"login", b"license", b"certificate", b"client", b"webhook", b"connection", b"secret", b"token", b"password", b"apikey", b"api_key", b"api key",
)
CONTEXT = re.compile(b"|".join(CONTEXT_WORDS), re.IGNORECASE)
LEAST = 16
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_.=~-]{%d,}" % LEAST)
NAME = re.compile(rb"[A-Za-z0-9_.-]*=+")
#: Bytes between a context word and the start of a candidate, at most.
DISTANCE = 64
#: Bytes of text before and after a candidate that prime the measurement.
AROUND = 512
NOVEL = 0.6
LEVEL = 3

#: The identifier dictionary: parts of names in code and configuration.
IDENTIFIERS = (
    "abstract access account action address admin agent alias allow amount analytics app append application archive argument array "
    "assert async attribute auth authorization backend background backup base batch bearer binary block body boolean branch bucket buffer "
    "build button cache callback cancel category certificate channel character check checksum children class client cloud cluster code "
    "collection color column command comment commit component config configuration connect connection console const container content "
    "context control cookie copy count create credential current customer data database date debug default delete deploy description "
    "device dictionary directory disable display document domain download driver element email enable encoding endpoint engine entity "
    "environment error event example exception execute export extension factory feature field file filter final float folder format "
    "function gateway generate global graph group handler hash header height host html http https icon identifier image import index "
    "input insert instance integer interface internal issue item iterator json kernel key keyword label language layer layout length "
    "level library license limit link list listener local location lock log login main manager map master max member memory menu message "
    "metadata method metric migration min mode model module monitor name namespace network node null number object offset option order "
    "output owner package page parameter parent parse partition password path pattern payload pending permission pipeline platform "
    "plugin pointer policy port position postgres prefix primary private process product production profile project property protocol "
    "provider proxy public publish query queue random range read record redirect reference region register registry release remote "
    "remove render replace report repository request reset resource response result return role root route row runtime sample scan "
    "schedule schema scope script search secret section select sender sequence serial server service session set settings shared signature "
    "signing size socket sort source spark special start state static status storage store stream string struct style subject submit "
    "success suffix summary support switch symbol sync system table target task team template test text thread time timeout timestamp "
    "title token tool top trace transaction transform trigger type union unique unit update upload upper uri url user username utf "
    "utility validate value variable vector version view volume warning web webhook width window worker workspace write yaml zone "
    "development staging testing localhost example.com 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "get_user_name setValue is_enabled MAX_LENGTH DEFAULT_TIMEOUT client_id client_secret access_token refresh_token session_id "
)

#: Long words of plain text, and the endings and beginnings that others share with them.
WORDS = (
    "accomplishments acknowledgement administration administratively anthropological approximately architectural authentication "
    "autobiographical biotechnology bibliographical characteristically characterization circumstances classification commercialization "
    "communications comprehensively computationally conceptualization confidentiality congratulations consciousness consequently "
    "considerations constitutionally contemporaneous conversationally correspondingly correspondence counterproductive "
    "crystallography decentralization democratization demonstrations departmental differentiation disappointments discrimination "
    "disproportionately electromagnetic electronically entrepreneurship environmentally epidemiological establishment experimentally "
    "extraordinarily fundamentally generalization geographically governmental gravitational hospitalization humanitarianism "
    "hypersensitivity identification implementations incomprehensible inconsequential independently industrialization infrastructures "
    "institutionalized instrumentation interchangeable interconnected interdependence interdisciplinary intergovernmental "
    "internationalization interpretations investigations jurisdictional knowledgeable mathematically meteorological microorganisms "
    "miscommunication misunderstandings multidimensional multiculturalism nationalization neighbourhoods neurophysiological "
    "notwithstanding organizational parliamentarian particularly pharmaceuticals philosophically photographically physiological "
    "predominantly professionalism psychologically rationalization recommendations reconciliation reconstruction rehabilitation "
    "representatives responsibilities revolutionaries satisfactorily semiconductors simultaneously sophistication specifications "
    "standardization straightforwardness superintendents telecommunications thermodynamics transcontinental transformations "
    "transportation triumphantly unconstitutional uncharacteristically underrepresented understandable unprecedented unquestionably "
    "unsatisfactory vulnerabilities whatsoever "
)


@functools.lru_cache(1)
def _compressor() -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict((WORDS + IDENTIFIERS).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False)


def novelty(before: bytes, candidate: bytes, after: bytes) -> float:
    """Compressed bytes that the candidate adds to its surroundings, per byte of it."""
    around = after + b"\n" + before
    alone = len(_compressor().compress(around))
    return (len(_compressor().compress(around + candidate)) - alone) / len(candidate)


_HEX = np.array([48 <= b <= 57 or 97 <= b <= 102 for b in range(256)])


def _hex_runs(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of all runs of at least HEX_CHARS hex digits that stay in one text."""
    if not len(data):
        return []
    inside = np.flatnonzero(_HEX[data])
    if not len(inside):
        return []
    new = np.ones(len(inside), bool)
    new[1:] = np.diff(inside) > 1
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    new |= edge[inside]
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(inside)) - 1
    long = lasts - firsts + 1 >= HEX_CHARS
    return list(zip(inside[firsts[long]].tolist(), (inside[lasts[long]] + 1).tolist(), strict=True))


def base_spans(raw: bytes, lower: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of assignments and access keys."""
    spans = []
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw) if len(m[2]) >= ASSIGN_CHARS]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= ACCESS_CHARS]
    return spans


def _parts(raw: bytes, start: int, end: int) -> list[tuple[int, int]]:
    """The string, or its name and its value if the value is long enough; only what is long enough."""
    name = NAME.match(raw, start, end)
    if name and end - name.end() >= LEAST:
        cut = start + len(name[0].rstrip(b"="))
        return [(s, e) for s, e in ((start, cut), (name.end(), end)) if e - s >= LEAST]
    return [(start, end)] if end - start >= LEAST else []


def novel_spans(raw: bytes, lower: bytes, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of novel strings in sensitive contexts that touch no span of ``taken``."""
    if not any(w in lower for w in CONTEXT_WORDS):
        return []
    ends = [m.end() for m in CONTEXT.finditer(raw)]
    spans = []
    # By start, with the furthest end so far: one look-up tells whether a string touches any of them.
    taken = sorted(taken)
    begins, reach = [a for a, _, _ in taken], list(itertools.accumulate((b for _, _, b in taken), max))
    for m in CANDIDATE.finditer(raw):
        start, end = m.span()
        # The last context word before the string, else the first one in it.
        k = bisect.bisect_right(ends, start)
        if not (k and start - ends[k - 1] <= DISTANCE):
            if k == len(ends) or ends[k] > end - LEAST:
                continue
            start = ends[k]
        for s, e in _parts(raw, start, end):
            before = bisect.bisect_left(begins, e)
            if before and reach[before - 1] > s:
                continue
            if novelty(raw[max(0, s - AROUND) : s], raw[s:e], raw[e : e + AROUND]) >= NOVEL:
                spans.append((s, 3, e))
    return spans


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches, "text"):
        data, offsets = buffer_of(batch.column("text"))
        runs: dict[int, list] = {}
        for a, b in _hex_runs(data, offsets):
            d = int(np.searchsorted(offsets, a, side="right")) - 1
            runs.setdefault(d, []).append((a - int(offsets[d]), 2, b - int(offsets[d])))
        whole, counts, digests, joined = data.tobytes(), [], [], []
        for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            raw = whole[a:b]
            lower = raw.lower()
            base = base_spans(raw, lower) + runs.get(d, [])
            extra = novel_spans(raw, lower, base)
            if base or extra:
                # Code points before each byte: those that do not continue a character.
                points = np.concatenate([[0], np.cumsum((data[a:b] & 0xC0) != 0x80)])
                base, extra = ([(int(points[s]), k, int(points[e])) for s, k, e in x] for x in (base, extra))
            counts.append([sum(k == i for _, k, _ in base) for i in range(3)])
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            joined.append(_joined(base + extra))
        n = np.array(counts, np.int64).reshape(-1, 3)
        yield with_arrays(
            batch, n_assign=pa.array(n[:, 0]), n_access=pa.array(n[:, 1]), n_hex=pa.array(n[:, 2]),
            base_sha256=pa.array(digests, pa.string()), spans=pa.array(joined, pa.string()),
        )


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_sha256 and spans."""
    return appended(docs, _scan, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            if spans:
                out, at = [], 0
                for span in spans.split(","):
                    kind, start, end = span.split(":")
                    if int(end) <= at:
                        continue
                    if int(start) >= at:
                        out += [text[at : int(start)], f"<{kind}>"]
                    at = int(end)
                text = "".join([*out, text[at:]])
            texts.append(text)
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))


def masked(scanned: DataFrame) -> DataFrame:
    """Scanned documents with each span of secrets (overlapping ones as one) replaced by its kind in angle brackets."""
    return map_batches(scanned, _mask, scanned.schema)
