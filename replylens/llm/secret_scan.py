"""Secret scans: fixed forms, and strings that zstandard cannot explain from their surroundings.

Fixed forms are found in the whole text, leftmost and non-overlapping per kind, and dropped if too
short. The novelty scan measures every string in the context of a sensitive word: the rest of the
identifier that holds the word, and what starts within NEAR characters behind it or, behind an
assignment, up to the end of the next line. Every string found there extends the context, so lists
of keys are followed to their end. The compressor is primed with a dictionary of common identifiers;
the marginal size of a string is what the text around it costs with the string less what it costs
without. Ordinary names repeat the dictionary or the surrounding code and cost little; keys cost about
a byte a character and are reported as `novel`. Long strings are measured in short parts against the
text around the whole string: in a long run of one alphabet the compressor learns the alphabet, and
random characters cost no more than its bits (0.75 bytes in base64, 0.5 in hex).

Offsets are code points, ends exclusive. Defined cases: null text is empty and has no spans; rows are
independent, so repeated rows, empty tables and other columns make no difference; a text of any
length is scanned whole.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "novel")
# The forms that are always looked for, and their least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
# Words that make a string near them sensitive, and words that code is full of.
SENSITIVE = (
    "auth bearer credential passphrase passcode password passwd pwd private secret token api_key api-key apikey "
    "access_key accesskey client_id signing signature session cookie jwt ssh-rsa ssh-ed25519 oauth encryption webhook connectionstring"
).split()
IDENTIFIERS = (
    "abstract account address application argument array async authentication authorization await base bearer "
    "boolean buffer callback certificate channel class client column config configuration connection const "
    "constructor container content context controller cookie credential credentials database datetime default "
    "delete description document documentation element encoding encryption endpoint environment error event "
    "example exception export expression extends false file filename final float format function generator "
    "getattr handler hash header host identifier implementation import index information initialize input "
    "instance integer interface internal iterator javascript json key lambda language length library list local "
    "localhost location logger management manager message metadata method middleware module namespace network "
    "none null number object operation option output package parameter parse passphrase path pattern permission "
    "placeholder private process production property protected protocol provider public query reference register "
    "repository request required resource response result return schema secret security self sequence server "
    "service session setting signature socket source static status storage string struct subscription table "
    "template test this thread timeout timestamp token transaction true tuple type undefined update user username "
    "utility validation value variable vector version virtual void webhook window writer your_api_key_here "
    "your_secret_token_here changeme xxxxxxxxxxxxxxxx 0123456789abcdef ABCDEFGHIJKLMNOPQRSTUVWXYZ"
)
NEAR, AROUND, LEAST_NOVEL, PART, NOVELTY = 128, 256, 16, 32, 0.8
DIGITS_SHARE = 0.7  # log2(10) / log2(26)


class SecretScanner:
    def __init__(self, novelty: float = NOVELTY, around: int = AROUND):
        import zstandard

        primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compress = zstandard.ZstdCompressor(level=6, dict_data=primed, write_content_size=False).compress
        self.novelty, self.around = novelty, around
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        # Equal to taking whole runs and dropping the short ones.
        self.access = re.compile(rf"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}")
        self.hex = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
        self.sensitive = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
        # What assigns does not belong to a string; what pads it does.
        self.string = re.compile(r"[A-Za-z0-9+/_~.-]+=*")
        self.identifier = re.compile(r"[A-Za-z0-9_-]*")
        self.assigns = re.compile(r"[:=]")
        self.is_hex = bytes(0x31 if chr(c) in "0123456789abcdef" else 0x30 for c in range(256))
        self.hex_run = b"1" * LEAST_HEX

    def base(self, text: str, lowered: str) -> list[tuple[int, int, int]]:
        """(start, kind's place, end) of the fixed forms. The cheap tests only skip useless searches."""
        found = []
        if any(word in lowered for word in ASSIGN_WORDS):
            found += [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in self.access.finditer(text)]
        if self.hex_run in text.encode("utf-8", "surrogatepass").translate(self.is_hex):
            found += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        return sorted(found)

    def cost(self, text: str) -> int:
        return len(self.compress(text.encode("utf-8", "surrogatepass")))

    def marginal(self, text: str, start: int, end: int, within: tuple[int, int] | None = None) -> float:
        """Compressed bytes that text[start:end] adds to the surroundings of `within`, itself by default, per byte."""
        first, last = within or (start, end)
        before, after = text[max(0, first - self.around) : first], text[last : last + self.around]
        return (self.cost(before + text[start:end] + after) - self.cost(before + after)) / (end - start)

    def limit(self, string: str) -> float:
        """Bytes a character from which on `string` is new: `novelty`, less where its alphabet is only digits.

        Random digits carry log2(10) bits each and can't cost what letters do.
        """
        return self.novelty * DIGITS_SHARE if string.isdigit() else self.novelty

    def is_novel(self, text: str, start: int, end: int) -> bool:
        """Whether text[start:end] is new to its surroundings; one of its parts, of even lengths, is enough."""
        before, after = text[max(0, start - self.around) : start], text[end : end + self.around]
        plain, limit = self.cost(before + after), self.limit(text[start:end])
        n = -((start - end) // PART)
        edges = [start + (end - start) * i // n for i in range(n + 1)]
        parts = zip(edges, edges[1:], strict=False)
        return any(self.cost(before + text[a:b] + after) - plain >= limit * (b - a) for a, b in parts)

    @staticmethod
    def overlaps(base: list[tuple[int, int, int]], at: int, start: int, end: int) -> bool:
        """Whether one of the spans from number `at` on meets start:end; at most three kinds meet at a place."""
        while at < len(base) and base[at][0] < end:
            if base[at][2] > start:
                return True
            at += 1
        return False

    def novel(self, text: str, lowered: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Strings in the context of a sensitive word that no fixed form overlaps."""
        if not any(word in lowered for word in SENSITIVE):
            return []
        found, last, at, line, next_line, named = [], 0, 0, -1, -1, -1
        for word in self.sensitive.finditer(text):
            # Words inside of one identifier share its end.
            if word.end() > named:
                named = self.identifier.match(text, word.end()).end()
            reach = named + NEAR
            if named > line:
                line = text.find("\n", named) % (len(text) + 1)
                next_line = text.find("\n", line + 1) % (len(text) + 1)
            if self.assigns.search(text, named, min(reach, line)):
                reach = max(reach, next_line)
            last = max(last, word.end())
            while m := self.string.search(text, last):
                start, end = m.span()
                if start >= reach:
                    break
                # The rest of the word's identifier is a string of its own.
                last = end = named if start < named < end else end
                if end - start < LEAST_NOVEL:
                    continue
                reach = max(reach, end + NEAR)
                while at < len(base) and base[at][2] <= start:
                    at += 1
                if self.overlaps(base, at, start, end):
                    continue
                if self.is_novel(text, start, end):
                    found.append((start, 3, end))
        return found

    def scan(self, text: str) -> tuple[list, list]:
        lowered = text.lower()
        base = self.base(text, lowered)
        return base, self.novel(text, lowered, base)


def joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame, novelty: float = NOVELTY) -> DataFrame:
    """doc_id, counts per fixed form, base_sha256, and `spans`, all spans as kind:start:end."""

    def run(batches):
        import pyarrow as pa

        scanner = SecretScanner(novelty)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, novel = scanner.scan(text.as_py() or "")
                kinds = [kind for _, kind, _ in base]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in range(3)), len(novel), digest, joined(sorted(base + novel))))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def spans_of(scanned: DataFrame) -> DataFrame:
    """One row (doc_id, kind, start, end) per span."""
    from pyspark.sql import functions as F

    parts = F.split("span", ":")
    return (
        scanned.filter("spans <> ''")
        .select("doc_id", F.explode(F.split("spans", ",")).alias("span"))
        .select("doc_id", parts[0].alias("kind"), parts[1].cast("long").alias("start"), parts[2].cast("long").alias("end"))
    )
