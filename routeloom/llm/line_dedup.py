"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

Two lines are linked when at most ``max_edits`` inserted, deleted or replaced
characters turn one into the other; ``longer`` allows more edits where the shorter of
the two has at least so many characters.  Each distinct line is cut into one segment
more than its edits: of two linked lines, at least one segment of the
shorter must stand in the longer as it is, moved by no more than the edits allow.

1. *Distinct lines.*  Lines are grouped by hash, checksum and length, with
   map-side combination, so a line that holds a third of all rows is one row.
2. *Index and probe.*  The index has (length, segment number, segment); a line
   probes it for each length it may link with, at the few starts that a matching
   left and right rest leaves possible; unmoved segments of equal length
   are the index's own keys, so the index also meets itself.  Candidates also need word parities
   (one bit a word hash) that differ by no more than ``3 * edits`` bits, as an
   edit changes three words at most, and counts of eight frequent letters that differ by no
   more than ``2 * edits`` in sum; that is part of the join itself, so
   a family of lines that differ in whole words gives few rows.
3. *Verification.*  Pairs whose character parities differ by more than
   ``2 * max_edits`` bits are out.  For the rest the common beginning and end are
   taken off.  What is left begins and ends with an edit, so of its inside a segment must
   stand in the other as it is (at one edit, nothing may be left); then the band of 2 * max_edits + 1 diagonals of what is left of the edit
   table is kept in two words of bits per column, by the recurrence of Hyyro.

Linked lines form classes (connected components), and of a class the first line
in order of (doc_id, line number) stays.

Lines of fewer than ``min_chars`` characters (headings, marks) are not linked to other lines, but
their exact repeats go as well, blank lines apart; without ``short_copies`` they are left alone.
Defined results: a null text has no line, an empty text one empty line; rows with
the same id count as one document, so a line at the same place of both is no
repetition; a null id is a document that comes before all others; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeloom.llm.components import components
from routeloom.session import dropped, tables_written, written

#: (characters, edits) of the production queries: lines so long may be so many edits apart.
LONG_LINES = ((64, 2),)
#: Letters whose counts tell lines apart; any eight are right, frequent ones tell most.
_LETTERS = "eainsrto"
_NULL_ID = -(2**63)  # stands for a null id inside joins


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, short_copies: bool = True) -> DataFrame:
    """(doc, line_no, line, length, h, crc) of the lines that can be removed."""
    able = F.col("length") >= min_chars
    if short_copies:
        able |= F.trim(F.translate("line", "\t\r\n", "   ")) != ""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    rows = rows.withColumn("length", F.char_length("line")).where(able)
    return rows.select("doc", "line_no", "line", "length", F.xxhash64("line").alias("h"), F.crc32(F.col("line").cast("binary")).alias("crc"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _segment_key(line: Column, length: Column, number: int, count: int, shift: int) -> Column:
    """Hash of (length, segment number, segment) for lines of ``length``, read ``shift`` characters further on."""
    begin = F.floor(length * number / count)
    size = F.floor(length * (number + 1) / count) - begin
    part = F.substr(line, (begin + 1 + shift).cast("int"), size.cast("int"))
    return F.xxhash64(length, F.lit(number), part)


def probe_places(max_edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment number, shift) that a longer line is probed at."""
    out = []
    for longer in range(max_edits + 1):
        for k in range(max_edits + 1):
            low = max(-k, longer - (max_edits - k))
            high = min(k, longer + (max_edits - k))
            out += [(longer, k, shift) for shift in range(low, high + 1)]
    return out


def _edits(length: Column, max_edits: int, longer: tuple[tuple[int, int], ...]) -> Column:
    """Edits that a line of ``length`` may be away from one at least as long."""
    allowed = F.lit(max_edits)
    for least, edits in sorted(longer):
        allowed = F.when(length >= least, F.lit(edits)).otherwise(allowed)
    return allowed


def _checked(max_edits: int, longer: tuple[tuple[int, int], ...]) -> list[int]:
    """The edits that lines may have, ascending; they must not fall as lines grow."""
    edits = [max_edits, *[e for _, e in sorted(longer)]]
    if edits != sorted(edits) or max_edits < 0:
        raise ValueError("longer lines must be allowed at least the edits of shorter ones")
    return sorted(set(edits))


def _keys(max_edits: int, longer: tuple[tuple[int, int], ...]) -> tuple[dict[str, Column], dict[str, Column]]:
    """(index keys, probe keys beyond these) of a line by name; null where its length has fewer."""
    known = _checked(max_edits, longer)
    line, length = F.col("line"), F.col("length")

    def slots(name: str, of: Column, at: dict[int, list[tuple[int, int]]]) -> dict[str, Column]:
        """One column per place in the longest list; ``at`` has (segment, shift) by the edits that lines of length ``of`` have."""
        out = {}
        for n in range(max(map(len, at.values()), default=0)):
            key = F.lit(None).cast("long")
            for edits, places in at.items():
                if n < len(places):
                    key = F.when(_edits(of, max_edits, longer) == edits, _segment_key(line, of, places[n][0], edits + 1, places[n][1])).otherwise(key)
            out[f"{name}{n}"] = key
        return out

    index = slots("i", length, {t: [(k, 0) for k in range(t + 1)] for t in known})
    probe = {}
    for more in range(known[-1] + 1):
        at = {t: [(k, shift) for d, k, shift in probe_places(t) if d == more and (more or shift)] for t in known}
        probe |= slots(f"p{more}_", length - more, at)
    return index, probe


def _parity(parts: Column) -> Column:
    """64 bits: how often, even or odd, the parts of a hash class come."""
    # shifting a long takes the lowest six bits of the hash
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.hash(w))))


def _signature(line: Column) -> Column:
    """Word parity in the upper 32 bits; below, counts of ``_LETTERS`` modulo 16."""
    words = _let(_parity(F.split(line, " ")), lambda p: F.call_function("shiftleft", p.bitwiseXOR(F.call_function("shiftrightunsigned", p, F.lit(32))), F.lit(32)))
    for n, letter in enumerate(_LETTERS):
        count = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))).bitwiseAND(F.lit(15))
        words = words.bitwiseOR(F.call_function("shiftleft", count.cast("long"), F.lit(4 * n)))
    return words


def _alike(a: Column, b: Column, edits: int) -> Column:
    """False where two signatures say that lines are more than ``edits`` apart."""
    apart = F.lit(0).cast("long")
    for n in range(len(_LETTERS)):
        more, less = (F.call_function("shiftrightunsigned", x, F.lit(4 * n)).bitwiseAND(F.lit(15).cast("long")) for x in (a, b))
        ahead, behind = (d.bitwiseAND(F.lit(15).cast("long")) for d in (more - less, less - more))
        apart += F.least(ahead, behind)
    words = F.bit_count(F.call_function("shiftrightunsigned", a.bitwiseXOR(b), F.lit(32)))
    return (words <= 3 * edits) & (apart <= 2 * edits)


def within_edits(a: Column, b: Column, max_edits: int) -> Column:
    """True where the edit distance of two texts is at most ``max_edits`` (banded, bit-parallel).

    ``max_edits`` is 30 at most, so that the band fits into one word of bits.
    """
    if not 0 <= max_edits <= 30:
        raise ValueError("max_edits must lie between 0 and 30")
    k = max_edits
    band = (1 << (2 * k + 1)) - 1
    word = lambda n: F.lit(n).cast("long")
    bit = lambda x, n: F.call_function("shiftright", x, n.cast("int")).bitwiseAND(word(1))

    def table(rows: Column, columns: Column) -> Column:
        height, width = F.size(rows), F.size(columns)

        def column(state: Column, j: Column) -> Column:
            at = F.get(columns, j - 1)
            match = word(0)
            for n in range(2 * k + 1):
                row = j - 1 - k + n
                same = (row >= 0) & (F.get(rows, F.greatest(row, F.lit(0))) == at)
                match = match.bitwiseOR(F.when(same, word(1 << n)).otherwise(word(0)))
            up, down = state["up"], state["down"]

            def with_diagonal(d: Column) -> Column:
                def with_across(p: Column) -> Column:
                    fewer = d.bitwiseAND(up)
                    shifted = F.call_function("shiftright", d, F.lit(1))
                    last = (height - j + k).cast("int")  # place of the last row in the band
                    score = state["score"] + F.when(j + k <= height, word(1) - bit(d, F.lit(2 * k))).otherwise(bit(p, F.greatest(last, F.lit(0))) - bit(fewer, F.greatest(last, F.lit(0))))
                    return F.struct(
                        fewer.bitwiseOR(F.bitwise_not(shifted.bitwiseOR(p)).bitwiseAND(word(band))).alias("up"),
                        shifted.bitwiseAND(p).alias("down"),
                        score.alias("score"),
                    )

                return _let(down.bitwiseOR(F.bitwise_not(d.bitwiseOR(up)).bitwiseAND(word(band))), with_across)

            def diagonal(x: Column) -> Column:
                return ((x.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(x).bitwiseOR(down).bitwiseAND(word(band))

            return _let(_let(match, diagonal), with_diagonal)

        start = F.struct(word(band & ~((1 << k) - 1)).alias("up"), word(0).alias("down"), word(k).alias("score"))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(width, F.lit(1))), start, column, lambda s: s["score"])

    def possible(x: Column, y: Column) -> Column:
        """False where the rests of two texts, which begin and end apart, need more than k edits.

        One edit goes to the beginning and another to the end, so between the ends of ``x`` at
        most k - 2 are left, and one of k - 1 segments there must stand in ``y`` as it is.
        """
        inner = F.char_length(x) - 2
        cut = lambda n: F.floor(inner * n / (k - 1))
        found = (inner <= 0) & F.lit(k > 1)
        for n in range(k - 1):
            found |= F.contains(y, F.substr(x, (cut(n) + 2).cast("int"), (cut(n + 1) - cut(n)).cast("int")))
        return found

    def apart(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        near = F.abs(F.char_length(x) - F.char_length(y)) <= k
        # with so few characters left the band would lie over the edge; no more than k edits are left either
        few = F.greatest(F.char_length(x), F.char_length(y)) <= k
        tight = F.least(F.char_length(x), F.char_length(y)) <= k
        return F.when(~near, F.lit(False)).when(few, F.lit(True)).when(~possible(x, y), F.lit(False)).when(tight, F.levenshtein(x, y) <= k).otherwise(table(F.split(x, ""), F.split(y, "")) <= k)

    return F.when(a == b, F.lit(True)).when(F.abs(F.char_length(a) - F.char_length(b)) > k, F.lit(False)).otherwise(_let(_trimmed(a, b), apart))


def _common(a: Column, b: Column, part) -> Column:
    """Length of the longest equal ``part(text, n)`` of two texts, by halving."""
    most = F.least(F.char_length(a), F.char_length(b)).cast("int")
    steps = F.sequence(F.lit(1), F.length(F.bin(most.cast("long"))))  # as many as the length has bits

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"] + 1) / 2).cast("int")
        same = part(a, middle) == part(b, middle)
        return F.struct(F.when(same, middle).otherwise(state["low"]).alias("low"), F.when(same, state["high"]).otherwise(F.greatest(middle - 1, state["low"])).alias("high"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), most.alias("high")), halve, lambda s: s["low"])


def _trimmed(a: Column, b: Column) -> Column:
    """(x, y): the texts without their common beginning and then their common end."""
    rest = lambda x, n: F.substr(x, n + 1)
    ahead = _let(_common(a, b, lambda x, n: F.substr(x, F.lit(1), n)), lambda n: F.struct(rest(a, n).alias("x"), rest(b, n).alias("y")))

    def behind(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        cut = lambda z, n: F.substr(z, F.lit(1), (F.char_length(z) - n).cast("int"))
        end = lambda z, n: F.substr(z, (F.char_length(z) - n + 1).cast("int"), n)
        return _let(_common(x, y, end), lambda n: F.struct(cut(x, n).alias("x"), cut(y, n).alias("y")))

    return _let(ahead, behind)


def _linked(docs: DataFrame, distinct: DataFrame, max_edits: int, longer: tuple[tuple[int, int], ...], id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(u, v): hashes of distinct lines that are linked."""
    known = _checked(max_edits, longer)
    names = [list(keys) for keys in _keys(max_edits, longer)]
    distinct = distinct.where(F.col("length") >= min_chars)
    index, probe = (distinct.select("h", "signature", F.explode(F.array(*named) if named else F.array().cast("array<bigint>")).alias("key")).where("key is not null") for named in names)
    alike = _alike(F.col("a.signature"), F.col("b.signature"), known[-1])
    meets = lambda other, which: index.alias("a").join(other.alias("b"), (F.col("a.key") == F.col("b.key")) & which & alike)
    pairs = meets(index, F.col("a.h") < F.col("b.h")).select(F.col("a.h").alias("u"), F.col("b.h").alias("v"))
    if names[1]:
        pairs = pairs.union(meets(probe, F.col("a.h") != F.col("b.h")).select(F.least("a.h", "b.h"), F.greatest("a.h", "b.h")))
    pairs = written(pairs.distinct(), "pairs")

    asked = pairs.select(F.col("u").alias("h")).union(pairs.select("v")).distinct()
    where = asked.join(distinct.select("h", "doc"), "h").groupBy("h").agg(F.min("doc").alias("doc"))
    holders = where.select("doc").distinct()
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"), F.col(text_col).alias("text")).join(holders, "doc", "left_semi")
    texts = _lines(keyed, "doc", "text", min_chars).select("h", "doc", "line").join(where, ["h", "doc"]).groupBy("h").agg(F.min("line").alias("line"))
    texts = written(texts.withColumn("letters", _parity(F.split("line", ""))), "texts")
    side = lambda c: texts.select(F.col("h").alias(c), F.col("line").alias(f"line_{c}"), F.col("letters").alias(f"letters_{c}"))
    full = pairs.join(side("u"), "u").join(side("v"), "v")
    allowed = _edits(F.least(F.char_length("line_u"), F.char_length("line_v")), max_edits, longer)
    # an edit takes one character away or puts one in, or both
    full = full.where(F.bit_count(F.col("letters_u").bitwiseXOR(F.col("letters_v"))) <= 2 * allowed)
    near = F.lit(False)
    for edits in known:
        near = F.when(allowed == edits, within_edits(F.col("line_u"), F.col("line_v"), edits)).otherwise(near)
    return full.where(near).select("u", "v")


def repeated_lines(docs: DataFrame, max_edits: int = 1, min_chars: int = 16, id_col: str = "doc_id", text_col: str = "text", short_copies: bool = True, longer: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """(doc, line_no, first_doc, first_line) of every line of a class of more than one place.

    ``first_doc`` and ``first_line`` name the class by its first place.  ``doc`` is the
    id, with -2**63 for null.
    """
    lines = _lines(docs, id_col, text_col, min_chars, short_copies)
    index, probe = _keys(max_edits, longer)
    keys = {**index, **probe}
    keyed = lines.select("doc", "h", "crc", "length", _signature(F.col("line")).alias("signature"), *[v.alias(n) for n, v in keys.items()])
    distinct = written(
        keyed.groupBy("h", "crc", "length").agg(F.min("doc").alias("doc"), F.count("*").alias("places"), F.max("signature").alias("signature"), *[F.max(n).alias(n) for n in keys]), "distinct"
    )
    before = tables_written()
    found = components(_linked(docs, distinct, max_edits, longer, id_col, text_col, min_chars)).withColumnRenamed("node", "h")
    dropped(docs.sparkSession, before, keep=1)  # all but what the components are read from
    marked = distinct.select("h", "crc", "length", "places").join(found, "h", "left").where("places > 1 or component is not null")
    marked = marked.select("h", "crc", "length", F.coalesce("component", "h").alias("c1"), F.when(F.col("component").isNull(), F.struct("crc", "length")).alias("c2"))
    places = written(lines.select("doc", "line_no", "h", "crc", "length").join(marked, ["h", "crc", "length"]).select("doc", "line_no", "c1", "c2"), "places")
    first = places.groupBy("c1", "c2").agg(F.min(F.struct("doc", "line_no")).alias("first"), F.count_distinct("doc", "line_no").alias("many")).where("many > 1")
    named = places.alias("x").join(first.alias("y"), (F.col("x.c1") == F.col("y.c1")) & F.col("x.c2").eqNullSafe(F.col("y.c2")))
    return named.select("x.doc", "x.line_no", F.col("first.doc").alias("first_doc"), F.col("first.line_no").alias("first_line")).distinct()


def _removed(docs: DataFrame, max_edits: int, min_chars: int, id_col: str, text_col: str, short_copies: bool, longer: tuple[tuple[int, int], ...]) -> DataFrame:
    """(doc, removed): per document the removed lines with the first places of their classes, in order."""
    lines = repeated_lines(docs, max_edits, min_chars, id_col, text_col, short_copies, longer).where("doc <> first_doc or line_no <> first_line")
    return lines.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("line_no", "first_doc", "first_line"))).alias("removed"))


def line_report(docs: DataFrame, max_edits: int = 1, min_chars: int = 16, id_col: str = "doc_id", text_col: str = "text", short_copies: bool = True, longer: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """One row per input row: id, n_lines, n_removed, removed.

    ``removed`` lists, in order of lines, ``line=first document:first line``; the right
    side names the class, and its first line stays.
    """
    gone = _removed(docs, max_edits, min_chars, id_col, text_col, short_copies, longer)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"), F.coalesce(F.size(F.split(text_col, "\n")), F.lit(0)).alias("n"))
    rows = rows.withColumn("n_lines", F.greatest("n", F.lit(0)))
    name = lambda r: F.concat(r["line_no"].cast("string"), F.lit("="), F.when(r["first_doc"] == _NULL_ID, "null").otherwise(r["first_doc"].cast("string")), F.lit(":"), r["first_line"].cast("string"))
    none = F.array().cast("array<struct<line_no:int,first_doc:bigint,first_line:int>>")
    joined = rows.join(gone, "doc", "left").withColumn("removed", F.coalesce("removed", none))
    return joined.select(F.col("id").alias(id_col), "n_lines", F.size("removed").alias("n_removed"), F.array_join(F.transform("removed", name), ",").alias("removed"))


def dedup_lines(docs: DataFrame, max_edits: int = 1, min_chars: int = 16, id_col: str = "doc_id", text_col: str = "text", short_copies: bool = True, longer: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """``docs`` with repeated lines taken out of the text.

    A document that has no character left but white space, and had one before, goes.
    """
    gone = _removed(docs, max_edits, min_chars, id_col, text_col, short_copies, longer).select(F.col("doc").alias("_gone_doc"), F.transform("removed", lambda r: r["line_no"]).alias("_gone_lines"))
    key = F.coalesce(docs[id_col].cast("long"), F.lit(_NULL_ID))
    joined = docs.join(gone, key == F.col("_gone_doc"), "left")
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda line, k: ~F.array_contains("_gone_lines", k))
    text = F.when(F.col("_gone_lines").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    joined = joined.withColumn("_new_text", text)
    joined = joined.where(F.col("_gone_lines").isNull() | (F.trim(F.translate("_new_text", "\t\r\n", "   ")) != ""))
    return joined.select(*[F.col("_new_text").alias(c) if c == text_col else F.col(c) for c in docs.columns])
