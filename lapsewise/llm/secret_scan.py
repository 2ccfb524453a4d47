"""Secret scan: fixed patterns, and zstandard novelty for what they miss.

Base spans are the matches of three patterns, leftmost and not overlapping within a kind; a match that
is too short is dropped, and what it covered isn't searched again. Beyond them, candidates are
strings of LEAST characters or more, with a digit and a letter, close to a sensitive word. A
candidate's novelty is what it adds to the compressed size of the text around it, where the compressor
is primed with a dictionary of identifiers: names, paths and copies of what stands near cost little, a
random string costs nearly its length. Long candidates are measured in pieces of PIECE characters and more, since
a compressor learns the alphabet of a long string. A candidate with a piece that costs BITS or more for each
character is reported.

The dictionary holds fixed identifiers and the IDENTIFIERS letter-only ones that stand near sensitive
words in the most documents, counted over all documents. Its size is bounded by that number.

Places are code points, ends exclusive. A null text counts as empty: no spans, and the digest of the
empty string. Repeated rows come out alike (and count as documents each), null keys pass through,
extra columns are ignored, an empty table gives an empty one. A text is held whole by the
task that reads its row.
"""

import re
import sys
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.sources.workspace import materialise

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds in their order, patterns, the least length of a match (of group 2 for assign).
KINDS = ["assign", "access", "hex", "novel"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")  # a match is always a whole run, so a short one covers nothing else
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
#: Words of which one stands in every match of ASSIGN.
ASSIGNED = ["password", "passwd", "secret", "token", "apikey", "api_key"]

#: Words near which a random string is suspect.
SENSITIVE = re.compile(r"passw|pwd|secret|token|api_?key|access_?key|private_?key|signing_?key|credential|authoriz|bearer", re.I | re.A)
#: A candidate has that many characters, a digit and a letter, and stands that close to a sensitive word.
LEAST, NEAR = 16, 40
RUN = re.compile("[A-Za-z0-9+/_=-]{%d,}" % LEAST)
LETTER, DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
#: Characters of text on either side that a candidate is measured against.
AROUND = 256
#: Compressed bits for each character from which a piece, and so its candidate, is reported; characters of a piece.
BITS, PIECE = 6.0, 48
IDENTIFIERS = 2048
IDENTIFIER = re.compile("[A-Za-z]{4,24}")
LEVEL = 9
#: Identifiers known without a corpus.
COMMON = (
    "access account admin algorithm authorization bearer begin certificate client config const credential database "
    "default digest domain encoding encrypted export false function header https identifier import integrity internal "
    "localhost login method module name null object origin password path private production project property provider "
    "public region request resource response return secret security server service session signature source string "
    "system target token true update user value version"
).split()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind."""
    spans = []
    low = text.lower()
    if any(word in low for word in ASSIGNED):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[dict], list[str]]:
    """Strings near a sensitive word that no span touches, with the text around them; and the identifiers near such words."""
    near = [(m.start(), m.end()) for m in SENSITIVE.finditer(text)]
    if not near:
        return [], []
    words = {x.lower() for a, b in near for x in IDENTIFIER.findall(text[max(0, a - AROUND) : b + AROUND])}
    starts, ends = [s[0] for s in spans], list(accumulate((s[2] for s in spans), max))
    begin, found = [a for a, _ in near], []
    for run in RUN.finditer(text):
        a, b = run.span()
        if not (DIGIT.search(run[0]) and LETTER.search(run[0])):
            continue
        nth = bisect_left(begin, b + NEAR)  # of the words that start before, the last one ends last
        if not nth or near[nth - 1][1] < a - NEAR:
            continue
        touched = bisect_left(starts, b)
        if not touched or ends[touched - 1] <= a:
            found.append({"start": a, "stop": b, "string": run[0], "around": text[max(0, a - AROUND) : a] + text[b : b + AROUND]})
    return found, sorted(words)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


class Novelty:
    """Compressed bits that a string adds to the text around it, for each of its characters."""

    def __init__(self, identifiers: list[str]):
        import zstandard

        # the end of a dictionary costs least to refer to
        primer = zstandard.ZstdCompressionDict(" ".join([*reversed(identifiers), *COMMON]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primer.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=primer, write_content_size=False, write_checksum=False, write_dict_id=False)

    def of(self, string: str, around: str) -> float:
        """That of the costliest piece; the last piece has what is left, so that none is shorter than PIECE in a longer string."""
        before = around.encode("utf-8", "surrogatepass")
        size = len(self.compressor.compress(before))
        pieces = max(1, len(string) // PIECE)
        parts = [string[i * PIECE : (i + 1) * PIECE if i + 1 < pieces else None].encode() for i in range(pieces)]
        return max(8 * (len(self.compressor.compress(before + part)) - size) / len(part) for part in parts)


SCANNED = (
    "n_assign long, n_access long, n_hex long, base string, words array<string>, "
    "candidates array<struct<start:int,stop:int,string:string,around:string>>"
)


def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for text in batch:
            text = text or ""
            spans = base_spans(text)
            counts = [sum(s[1] == kind for s in spans) for kind in range(3)]
            found, words = candidates(text, spans)
            rows.append((*counts, written(spans), words, found))
        yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "words", "candidates"])


def identifiers(scanned: DataFrame, most: int = IDENTIFIERS) -> list[str]:
    """The identifiers near sensitive words of the most documents, most frequent first."""
    each = scanned.select(F.explode("words").alias("word")).groupBy("word").count()
    return [r["word"] for r in each.orderBy(F.desc("count"), "word").limit(most).collect()]


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_assign, n_access, n_hex, n_novel, base (spans as text) and spans (those and the novel ones)."""
    found = docs.select(F.col(f"`{key}`").alias("_key"), F.pandas_udf(scan, SCANNED)(F.col(f"`{text}`")).alias("_found"))
    found = materialise(found.select("_key", "_found.*"), "secrets")
    known = docs.sparkSession.sparkContext.broadcast(identifiers(found))  # IDENTIFIERS words of up to 24 letters

    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        novelty = Novelty(known.value)
        for base, strings in batches:
            rows = []
            for spans, each in zip(base, strings):
                novel = [(x["start"], 3, x["stop"]) for x in each if novelty.of(x["string"], x["around"]) >= BITS]
                own = [(int(a), KINDS.index(kind), int(b)) for kind, a, b in (s.split(":") for s in spans.split(",") if s)]
                rows.append((len(novel), written(own + novel)))
            yield pd.DataFrame(rows, columns=["n_novel", "spans"])

    any_ = found.withColumn("_judged", F.when(F.size("candidates") > 0, F.pandas_udf(judge, "n_novel long, spans string")("base", "candidates")))
    return any_.select(
        F.col("_key").alias(key), "n_assign", "n_access", "n_hex",
        F.coalesce("_judged.n_novel", F.lit(0).cast("long")).alias("n_novel"), "base", F.coalesce("_judged.spans", "base").alias("spans"),
    )
