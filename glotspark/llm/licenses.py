"""License scans by canonical digests.

A unit of text, a whole document or one of its lines, is brought to a canonical form: lower case,
copyright lines left out, equivalent spellings made one, every run of other characters than letters
and digits one space. Units whose digest is that of a known licence text are reported, by one hash
join against the small table of known texts.

A third unit is a block, a run of lines: a known text that is wrapped or goes over paragraphs, alone
or anywhere in a longer document. Blocks are looked for in documents that hold a marker of a known
text, by its canonical form, which has to begin and end with a line.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glotspark.functions.storage import BROADCAST_BYTES

# Spellings that licence matching treats alike.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "authorisation": "authorization",
    "authorised": "authorized",
    "catalogue": "catalog",
    "centre": "center",
    "colour": "color",
    "customisation": "customization",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

# Notices by which texts name their licence, and short licence texts.
KNOWN = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies."
    ),
    "FSFAP": (
        "Copying and distribution of this file, with or without modification, are permitted in any"
        " medium without royalty provided the copyright notice and this notice are preserved. This"
        " file is offered as-is, without any warranty."
    ),
}

_COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*"
_SPELLED = r"(^|[^a-z0-9])(" + "|".join(SPELLINGS) + r")($|[^a-z0-9])"


# A copyright line for sure, with a sign or year at its head; any other may be a wrapped line of a
# licence, as "copyright holders be" or "copyright treaty adopted on 20 December 1996".
_DATED = r"^[^a-z0-9]*(©|(copyright|\(c\))[^a-z0-9©]*(©|\(c\)|(19|20)[0-9]{2}|[\[<{(] *(year|yyyy)))"

# Parts of words, one of which nearly every known text has in whatever spelling.
_MARKERS = ("licen", "permi", "warrant")


def known_texts() -> list[tuple[str, str]]:
    """``(license, text)``: those of ``KNOWN`` and the full texts in the package.

    Full texts start behind title, preamble and copyright lines and end before the appendix, as
    these vary. What follows ``~`` in a file's name tells variants of one licence apart.
    """
    files = sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=str)
    full = [
        (file.name.removesuffix(".txt").split("~")[0], file.read_text("utf-8"))
        for file in files
        if file.name.endswith(".txt")
    ]
    return [*KNOWN.items(), *full]


def _pairs(known: Mapping[str, str] | Iterable[tuple[str, str]] | None) -> list[tuple[str, str]]:
    if known is None:
        return known_texts()
    return list(known.items() if isinstance(known, Mapping) else known)


def canonical(text: Column) -> Column:
    """The canonical form; a null text has none, a text of nothing but punctuation an empty one."""
    return _folded(F.regexp_replace(F.lower(text), _COPYRIGHT_LINE, "$1"))


def _folded(lowered: Column) -> Column:
    spaced = F.concat(
        F.lit(" "), F.trim(F.regexp_replace(lowered, "[^\\p{L}\\p{N}]+", " ")), F.lit(" ")
    )
    one_spelling = spaced
    for variant, usual in SPELLINGS.items():
        one_spelling = F.replace(one_spelling, F.lit(f" {variant} "), F.lit(f" {usual} "))
    return F.trim(F.when(lowered.rlike(_SPELLED), one_spelling).otherwise(spaced))


def known_digests(
    spark: SparkSession, known: Mapping[str, str] | Iterable[tuple[str, str]] | None = None
) -> DataFrame:
    """``(license, digest)`` of the known texts, one row per digest: the least name."""
    pairs = _pairs(known)
    if sum(len(name) + len(text) for name, text in pairs) > BROADCAST_BYTES:
        raise ValueError("too many known texts for one small table")
    table = spark.createDataFrame(pairs, "license string, known string")
    digests = table.select("license", F.sha2(canonical(F.col("known")), 256).alias("digest"))
    return digests.groupBy("digest").agg(F.min("license").alias("license")).coalesce(1)


def scan(
    df: DataFrame,
    known: Mapping[str, str] | Iterable[tuple[str, str]] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, unit, line, license, digest)`` of every unit that is a known licence text.

    ``unit`` is "text" with line 0 for a whole document, "line" with the line's number from 1 for
    one of its lines, "block" with the number of the first for a run of lines; the digest is that
    of the known text. Null and empty texts, and units that are empty in canonical form, match
    nothing. Repeated rows and null keys each give their own matches. The known texts are a table
    of checked size, so the texts stay where they are; by default those of ``known_texts``.
    """
    pairs = _pairs(known)
    units = df.select(
        F.col(key).alias("doc_id"), F.posexplode(F.concat(F.array(text), F.split(text, "\n")))
    ).select(
        "doc_id",
        F.when(F.col("pos") == 0, "text").otherwise("line").alias("unit"),
        F.col("pos").cast("long").alias("line"),
        # Generated once, although the filter and the join both need it.
        F.explode(F.array(canonical(F.col("col")))).alias("canonical"),
    )
    digested = units.filter("canonical != ''").select(
        "doc_id", "unit", "line", F.sha2("canonical", 256).alias("digest")
    )
    found = known_digests(df.sparkSession, pairs)
    return (
        digested.join(F.broadcast(found), "digest")
        .select("doc_id", "unit", "line", "license", "digest")
        .union(_blocks(df, pairs, key, text))
    )


def _lines(text: Column) -> Column:
    """Every line's canonical form and what it is: 2 for a copyright line, 1 for what may be one."""

    def line(each: Column) -> Column:
        lowered = F.lower(each)
        dated = F.when(lowered.rlike(_DATED), 2).otherwise(1)
        kind = F.when(lowered.rlike(_COPYRIGHT_LINE), dated).otherwise(0)
        return F.struct(_folded(lowered).alias("form"), kind.alias("kind"))

    return F.transform(F.split(text, "\n"), line)


def _joined(lines: list[dict], most: int) -> tuple[str, dict[int, int], dict[int, int]]:
    """The forms of lines up to a kind, with a space around each, and where which line begins and
    ends: the place of the space before it and of that after it."""
    parts, begins, ends, at = [], {}, {}, 0
    for number, line in enumerate(lines, 1):
        if line["kind"] <= most and line["form"]:
            parts.append(line["form"])
            begins[at] = number
            at += len(line["form"]) + 1
            ends[at] = number
    return f" {' '.join(parts)} ", begins, ends


def _marker(form: str) -> str:
    """What every text with this canonical form has in small letters, whatever its spelling."""
    usual = {*SPELLINGS.values()}
    words = [word for word in form.split() if word not in usual]
    return next((m for m in _MARKERS if m in form), max(words, key=len, default=""))


def _blocks(df: DataFrame, pairs: list[tuple[str, str]], key: str, text: str) -> DataFrame:
    """Runs of lines that are known texts, in the columns of ``scan``.

    A wrapped line of a licence may begin like a copyright line. So each document is read twice:
    without any line that begins so, and without those only that have a year or a sign at their head.
    """
    spark = df.sparkSession
    table = spark.createDataFrame(pairs, "license string, known string").select(
        "license", _lines(F.col("known")).alias("lines"), F.sha2(canonical(F.col("known")), 256)
    )
    forms: list[dict[str, tuple[str, str]]] = [{}, {}]
    for license, lines, digest in sorted(table.collect(), key=lambda row: row[0], reverse=True):
        for most in (0, 1):
            form = _joined(lines, most)[0]
            if form.strip():
                forms[most][form] = (license, digest)
    markers = sorted({_marker(form) for each in forms for form in each})
    shared = spark.sparkContext.broadcast(forms)
    schema = T.StructType(
        [
            T.StructField("doc_id", df.schema[key].dataType),
            T.StructField("unit", T.StringType()),
            T.StructField("line", T.LongType()),
            T.StructField("license", T.StringType()),
            T.StructField("digest", T.StringType()),
        ]
    )

    def found(lines: list[dict]) -> set[tuple[int, int, str, str]]:
        out = set()
        for most, known in enumerate(shared.value):
            joined, begins, ends = _joined(lines, most)
            for form, (license, digest) in known.items():
                at = joined.find(form)
                while at >= 0:
                    first, last = begins.get(at), ends.get(at + len(form) - 1)
                    # A single line is a unit of its own.
                    if first is not None and last is not None and first < last:
                        out.add((first, last, license, digest))
                    at = joined.find(form, at + 1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, lines in enumerate(batch.column("lines")):
                out += [(row, *each) for each in sorted(found(lines.as_py()))]
            rows, firsts, _, licenses, digests = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(["block"] * len(out), pa.string()),
                    pa.array(firsts, pa.int64()),
                    pa.array(licenses, pa.string()),
                    pa.array(digests, pa.string()),
                ],
                names=schema.names,
            )

    lowered = F.lower(F.col(text))
    marked = F.lit(False)
    for marker in markers:
        marked |= F.contains(lowered, F.lit(marker))
    candidates = df.filter(marked & F.contains(F.col(text), F.lit("\n")))
    return candidates.select(F.col(key).alias("doc_id"), _lines(F.col(text)).alias("lines")).mapInArrow(
        run, schema
    )


def sql(known: Mapping[str, str] = KNOWN) -> str:
    """The same over a table ``documents`` in DuckDB."""

    def canonical_sql(text: str) -> str:
        lowered = (
            f"regexp_replace(lower({text}), '(^|\\n)[^a-z0-9\\n]*(copyright|\\(c\\)|©)[^\\n]*',"
            " '\\1', 'g')"
        )
        spaced = f"' ' || trim(regexp_replace({lowered}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
        for variant, usual in SPELLINGS.items():
            spaced = f"replace({spaced}, ' {variant} ', ' {usual} ')"
        return f"trim({spaced})"

    rows = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in known.items()
    )
    return f"""
    WITH known(license, known) AS (VALUES {rows}),
    digests AS (SELECT sha256({canonical_sql("known")}) AS digest, min(license) AS license
        FROM known GROUP BY 1),
    units AS (SELECT doc_id, 'text' AS unit, 0::BIGINT AS line, text AS part FROM documents
        UNION ALL SELECT doc_id, 'line', unnest(range(1, len(lines) + 1)), unnest(lines)
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)),
    forms AS (SELECT doc_id, unit, line, {canonical_sql("part")} AS form FROM units)
    SELECT doc_id, unit, line, license, digest
    FROM (SELECT doc_id, unit, line, sha256(form) AS digest FROM forms WHERE form != '')
    JOIN digests USING (digest)
    """
