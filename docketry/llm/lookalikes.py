"""Visually identical text with different characters, brought to one form.

Width variants, ligatures, numeral signs, split accents, invisible characters, odd spaces and look-alike hyphens have a
fixed usual form. For letters the word decides: the scripts each letter could belong to (its own and those with a
look-alike) are intersected over the token; a mixed token takes the script all its letters can be read in, and a token
wholly of look-alikes takes its neighbours' script.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of Cyrillic and Greek with the Latin letters they look like.
CYRILLIC = "аеорсухѕіјһԁԛԝАВЕКМНОРСТУХЅІЈ"
CYRILLIC_AS_LATIN = "aeopcyxsijhdqwABEKMHOPCTYXSIJ"
GREEK = "οναικρυγΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
GREEK_AS_LATIN = "ovaikpuyABEZHIKMNOPTYX"

# Hyphens that look like the usual one.
HYPHENS = "‐‑⁃˗−﹣－"
# Invisible characters outside the format category.
BLANK_LETTERS = "͏ᅟᅠ឴឵ㅤﾠ"
# Compatibility characters that are usual typography and stay.
USUAL = "…™ªº¹²³"

TO_LATIN = dict(zip(CYRILLIC + GREEK, CYRILLIC_AS_LATIN + GREEK_AS_LATIN))
FROM_LATIN = {
    "CYRILLIC": {b: a for a, b in zip(CYRILLIC, CYRILLIC_AS_LATIN)},
    "GREEK": {b: a for a, b in zip(GREEK, GREEK_AS_LATIN)},
}

_WORD = re.compile(r"[^\W\d_]+(?:[\d_]*[^\W\d_]+)*")
_NUMERAL = re.compile(r"[IVXLCDM]+$")


@functools.lru_cache(maxsize=65536)
def script_of(ch: str) -> str:
    """First word of the letter's name (LATIN, GREEK, CYRILLIC ...); empty for digits and signs."""
    return unicodedata.name(ch, "").split(" ")[0] if ch.isalpha() else ""


@functools.lru_cache(maxsize=65536)
def resolved(ch: str) -> frozenset[str]:
    """Scripts in which the letter could be read: its own and those with a look-alike."""
    own = script_of(ch)
    out = {own}
    if own == "LATIN":
        out |= {s for s, table in FROM_LATIN.items() if ch in table}
    elif ch in TO_LATIN:
        out.add("LATIN")
        out |= {s for s, table in FROM_LATIN.items() if TO_LATIN[ch] in table}
    return frozenset(out)


@functools.lru_cache(maxsize=65536)
def usual_form(ch: str) -> str:
    """The usual form of one character, regardless of its neighbours; letters keep their script."""
    if ch < "\x7f" and ch != "\t":
        return ch
    kind = unicodedata.category(ch)
    if kind == "Cf" or ch in BLANK_LETTERS or "︀" <= ch <= "️":
        return ""
    if kind == "Zs" or ch == "\t":
        return " "
    if ch in HYPHENS:
        return "-"
    how = unicodedata.decomposition(ch)
    if ch in USUAL or how.startswith(("<fraction>", "<super>", "<sub>", "<compat> 0020")):
        return ch
    return unicodedata.normalize("NFKC", ch)


def respell(token: str, script: str) -> str:
    """The token with every letter that has a look-alike in the script written in it."""
    out = []
    for ch in token:
        if script_of(ch) not in ("", script):
            latin = TO_LATIN.get(ch, ch)
            ch = latin if script == "LATIN" else FROM_LATIN.get(script, {}).get(latin, ch)
        out.append(ch)
    return "".join(out)


@functools.lru_cache(maxsize=65536)
def token_scripts(token: str) -> tuple[frozenset[str], frozenset[str]]:
    """(scripts that occur, scripts in which the whole token could be read)."""
    letters = [c for c in token if c.isalpha()]
    return frozenset(map(script_of, letters)), frozenset.intersection(*map(resolved, letters))


def _runs(token: str) -> list[tuple[str, str]]:
    runs: list[list[str]] = []
    for ch in token:
        s = script_of(ch)
        if runs and (s in ("", runs[-1][0])):
            runs[-1][1] += ch
        else:
            runs.append([s, ch])
    return [tuple(r) for r in runs]


def _two_words(token: str) -> bool:
    """Two proper words that lost the space between them: one run of each script, each sure of its script."""
    runs = _runs(token)
    if len(runs) != 2 or min(len(t) for _, t in runs) < 2:
        return False
    return all(any(len(resolved(c)) == 1 for c in t) or (s == "LATIN" and _NUMERAL.match(t)) for s, t in runs)


def _pick(token: str, own: frozenset[str], whole: frozenset[str]) -> str:
    if len(whole & own) == 1:
        return next(iter(whole & own))
    if "LATIN" in whole:
        return "LATIN"
    sure = [script_of(c) for c in token if c.isalpha() and len(resolved(c)) == 1]
    letters = sure or [script_of(c) for c in token if c.isalpha()]
    return max(sorted(set(letters)), key=letters.count)


def normal_line(line: str, page_script: str = "LATIN") -> str:
    """The line in one consistent form; equal to the line where nothing had to change."""
    if line.isascii() and "\t" not in line:
        return line
    text = unicodedata.normalize("NFC", "".join(map(usual_form, line)))
    if text.isascii():
        return text
    found = [m for m in _WORD.finditer(text) if any(c.isalpha() for c in m[0])]  # a fraction sign is no word
    scripts = [token_scripts(m[0]) for m in found]
    out, at = [], 0
    for k, (m, (own, whole)) in enumerate(zip(found, scripts)):
        token = m[0]
        if len(own) > 1:
            if not _two_words(token):
                token = respell(token, _pick(token, own, whole))
        elif len(whole) > 1 and page_script not in own and not (own == {"LATIN"} and _NUMERAL.match(token)):
            # a wide gap parts the lines of two columns, so what stands behind it is no neighbour
            near = [scripts[i][0] for i in (k - 1, k + 1) if 0 <= i < len(found) and len(scripts[i][1]) == 1 and "  " not in text[min(found[i].end(), m.end()) : max(found[i].start(), m.start())]]
            around = set().union(*near)
            if len(around) == 1 and not around & own and around <= whole:
                token = respell(token, next(iter(around)))
        out += [text[at : m.start()], token]
        at = m.end()
    return "".join(out) + text[at:]


def page_script_of(text: str) -> str:
    """Script of most letters of a page."""
    letters = [s for s in map(script_of, text) if s]
    return max(sorted(set(letters)), key=letters.count) if letters else "LATIN"


def changed_lines(text: str):
    """(line number from 0, line, normal line) of every line of the text that has to change."""
    script = None
    for n, line in enumerate(text.split("\n")):
        if line.isascii() and "\t" not in line:
            continue
        script = script or page_script_of(text)
        normal = normal_line(line, script)
        if normal != line:
            yield n, line, normal


def _suspect(text: str):
    return F.col(text).rlike(r"[^\x00-\x7F]|\t")


def lookalike_lines(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no, line, normal) of the lines that had to change.

    Pages of plain ASCII are settled in the JVM and never reach Python. Null and empty texts have no rows; repeated
    documents give repeated rows; the work is row-local, so nothing is shuffled and hot sources do not matter.
    """
    kind = documents.schema[key].dataType.simpleString()
    schema = pa.schema([(key, pa.int64() if kind == "bigint" else pa.string()), ("line_no", pa.int64()), ("line", pa.string()), ("normal", pa.string())])

    def scan(batches):
        for batch in batches:
            rows = [(k, *x) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in changed_lines(t)]
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    pages = documents.where(_suspect(text)).select(F.col(key) if kind == "bigint" else F.col(key).cast("string"), text)
    return pages.mapInArrow(scan, f"{key} {'bigint' if kind == 'bigint' else 'string'}, line_no bigint, line string, normal string")


def normalise_text(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its text in one consistent form and the number of changed lines; null stays null.

    One scan: a page of plain ASCII passes through Python as a null and comes out as it was.
    """

    @F.pandas_udf("struct<normal string, n int>")
    def rewrite(texts):
        import pandas as pd

        rows = []
        for t in texts:
            if t is None:
                rows.append((None, 0))
                continue
            lines = t.split("\n")
            n = 0
            for at, _, normal in changed_lines(t):
                lines[at] = normal
                n += 1
            rows.append(("\n".join(lines) if n else None, n))
        return pd.DataFrame(rows, columns=["normal", "n"])

    read = documents.select(key, text, F.when(_suspect(text), F.col(text)).alias("_odd")).withColumn("_x", rewrite("_odd"))
    return read.select(key, F.coalesce("_x.normal", text).alias("normal"), F.coalesce("_x.n", F.lit(0)).alias("n_changed"))
