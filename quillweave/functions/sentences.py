"""Sentences with their offsets (code points), in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillweave.functions.arrays import let, running_starts

# Words whose full stop ends no sentence.
ABBREVIATIONS = (
    "e.g i.e vs cf fig figs al approx ca no nos dr mr mrs ms prof resp ref refs eq vol sp spp "
    "inc ltd co st jan feb mar apr jun jul aug sep sept oct nov dec p"
)
#: White space as Python has it: ranges of code points, all characters, the inside of a class.
_RANGES = ((9, 13), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
BLANKS = "".join(chr(c) for a, b in _RANGES for c in range(a, b + 1))
_CLASS = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in _RANGES)
#: Stand for a sentence's end, and for a full stop that is none.
MARK, HOLD = "\x01", "\x02"
#: A short word: an abbreviation in any case (ASCII letters) or one letter whose small form is one letter too
#: (two capitals are newer than the pattern's letters, their small forms aren't).
_ASCII = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else f"\\{c}" for c in w) for w in ABBREVIATIONS.split())
_SHORT = rf"(?:{_ASCII}|[[\p{{L}}\x{{A7CB}}\x{{A7DC}}]&&[^\x{{130}}]])"
#: The full stop of a short word that begins after white space or a bracket, where a sentence could end. It begins with the sign, so
#: that nothing is looked at elsewhere.
STOP = rf"\.(?<=(?<![^{_CLASS}(\[]){_SHORT}\.)(?=[\"')\]]?[{_CLASS}])"
#: Such a stop where the brackets follow on something else: then the word is longer than it looks.
JOINED = rf"([(\[](?<=[^{_CLASS}(\[][(\[])[(\[]*+{_SHORT}\.){HOLD}"
#: A sign, maybe a closing quote or bracket, white space, and then a capital, a bracket or a quote.
END = rf"([.!?][\"')\]]?[{_CLASS}]++)(?=[\p{{IsUppercase}}(\[\"'])"


def _placed(text: Column) -> Column:
    """array<struct<start,end,text>> of a text that holds neither mark."""
    held = F.regexp_replace(F.regexp_replace(text, STOP, f"$0{HOLD}"), JOINED, "$1")
    marked = F.translate(F.regexp_replace(held, END, f"$1{MARK}"), HOLD, "")
    placed = let(F.split(marked, MARK), lambda s: F.arrays_zip(s, running_starts(F.transform(s, F.length)))).cast("array<struct<text:string,start:int>>")

    def span(p: Column) -> Column:
        body = F.ltrim(p["text"], F.lit(BLANKS))
        return let(F.struct((p["start"] + F.length(p["text"]) - F.length(body)).alias("start"), F.rtrim(body, F.lit(BLANKS)).alias("text")), lambda b: F.struct(b["start"].alias("start"), (b["start"] + F.length(b["text"])).alias("end"), b["text"].alias("text")))

    return F.filter(F.transform(placed, span), lambda s: s["end"] > s["start"])


def sentences(text: Column) -> Column:
    """array<struct<start,end,text>>: white space trimmed, end exclusive. A null or blank text has none.

    Full stops of short words are held first, then the ends that count are marked and the text is split there, so work grows with the
    text's length alone: every sentence is cut out of the text once. Offsets are sums of lengths, as they count code points. The marks
    can stand for any sign that is neither blank nor capital, so where the text holds one it is another of that kind meanwhile, and the
    sentences are read from the text itself. A text in which no sentence could end before its own end is one sentence.
    """
    plain = F.coalesce(text, F.lit(""))
    body = F.ltrim(plain, F.lit(BLANKS))
    start, trimmed = F.length(plain) - F.length(body), F.rtrim(body, F.lit(BLANKS))
    one = F.array(F.struct(start.alias("start"), (start + F.length(trimmed)).alias("end"), trimmed.alias("text")))
    strange = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.substring(plain, s["start"] + 1, s["end"] - s["start"]).alias("text"))
    return F.when(~plain.rlike(END), F.when(trimmed == "", F.slice(one, 1, 0)).otherwise(one)).when(plain.rlike(f"[{MARK}{HOLD}]"), F.transform(_placed(F.translate(plain, MARK + HOLD, "\x03\x03")), strange)).otherwise(_placed(plain))


def sentence_spans(text: Column) -> Column:
    """array<struct<start,end>> of the sentences."""
    return F.transform(sentences(text), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def document_sentences(title: Column, abstract: Column) -> Column:
    """array<struct<index,start,end,text>>: the title's sentences, then the abstract's, whose offsets are those in title
    + blank + abstract."""
    shift = F.length(F.coalesce(title, F.lit(""))) + 1
    moved = F.transform(sentences(abstract), lambda s: F.struct((s["start"] + shift).alias("start"), (s["end"] + shift).alias("end"), s["text"].alias("text")))
    return F.transform(F.concat(sentences(title), moved), lambda s, i: F.struct(i.alias("index"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")))
