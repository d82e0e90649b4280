"""Personal data: patterns, and terms that give a protected entity away. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import materialized, width

# Kinds in their order, and what each looks like. Fixed values.
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), each part at most 255
#   card  [0-9]([\x20-]?[0-9])+, 12 to 19 digits, Luhn sum
#   phone \+[0-9][\x20().0-9-]+[0-9], 9 to 15 digits
KINDS = ("email", "ip", "card", "phone")
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)

# The same expressions for a backtracking matcher: what cannot give back is possessive (long runs
# neither overflow the stack nor are tried from every position), and a match starts where a run
# starts or the last match ended.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
# Whatever matches one of them has such a place.
_MAYBE = r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]|[0-9]\.[0-9]++\.[0-9]++\.[0-9]|[0-9](?:[\x20-]?[0-9]){11}|\+[0-9]"

# A term is a run of letters and digits with a letter in it.
_TERM = r"[\p{L}\p{N}]+"
_NOT_TERM = r"[^\p{L}\p{N}]+"
TERM = "term"
PIECE = 128


def matches(text: Column, pattern: str) -> Column:
    """Matches, leftmost and non-overlapping, as an array of ``start``, ``end``, ``value``.

    The pattern cannot match the empty string. Positions are code points, the end exclusive: the
    text is cut at the matches, and the lengths of the pieces are added up.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def add_piece(state: Column, piece: Column) -> Column:
        return F.aggregate(piece, F.struct(state["at"].alias("at"), empty.alias("spans")), add, lambda own: F.struct(
            own["at"].alias("at"), F.concat(state["pieces"], F.array(own["spans"])).alias("pieces")))

    def placed(pairs: Column) -> Column:
        # In pieces, since appending copies the array at every step.
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / PIECE).cast("int")), lambda i: F.slice(pairs, i * PIECE + 1, F.lit(PIECE)))
        none = F.array().cast("array<array<struct<start:int,end:int,value:string>>>")
        spans = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("pieces")), add_piece, lambda state: F.flatten(state["pieces"]))
        return F.when(F.size(pairs) == 0, empty).otherwise(spans)

    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("value"))
    pairs = F.filter(pairs, lambda p: p["value"].isNotNull())
    return F.transform(F.array(pairs), placed)[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; the digits of all sum to a multiple of ten."""
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")

    def worth(digit: Column, place: Column) -> Column:
        number = digit.cast("int")
        twice = number * 2
        return F.when(place % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(number)

    total = F.aggregate(F.transform(reverse, worth), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _between(value: Column, bounds: tuple[int, int]) -> Column:
    return F.length(value).between(*bounds)


def _kept(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(_BYTE))
    if kind == "card":
        digits = _digits(value)
        return F.when(_between(digits, CARD_DIGITS), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return _between(_digits(value), PHONE_DIGITS)
    return F.lit(True)


def _spans_of(text: Column, kind: str, rank: int, pattern: str) -> Column:
    found = F.filter(matches(text, pattern), lambda m: _kept(kind, m["value"]))
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"),
        F.lit(kind).alias("kind"), m["value"].alias("value")))


def base_spans(text: Column) -> Column:
    """All base spans as an array of ``start``, ``rank``, ``end``, ``kind``, ``value``, sorted."""
    text = F.coalesce(text, F.lit(""))
    patterns = zip(KINDS, (_EMAIL, _IP, _CARD, _PHONE), strict=True)
    return F.array_sort(F.concat(*[_spans_of(text, kind, rank, pattern) for rank, (kind, pattern) in enumerate(patterns)]))


def _entity(span: Column) -> Column:
    """What the span names, however it is written."""
    plain = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat_ws(":", span["kind"], plain)


def _words(found: DataFrame) -> DataFrame:
    """``key``, ``term``, ``start``, ``end`` of all terms of the documents that hold an entity, base spans left out."""
    each = found.select("key", "base", F.explode(matches(F.col("text"), _TERM)).alias("m")).where(F.col("m.value").rlike(r"\p{L}"))
    each = each.select("key", "base", F.lower("m.value").alias("term"), "m.start", "m.end")
    return each.where(~F.exists("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))).drop("base")


def _holders(found: DataFrame) -> DataFrame:
    """``key``, ``rows``, ``group``, ``with_entity``: the entities of each document and the rows that hold them.

    Entities of exactly the same documents tell the same, so they are one group, known by two
    checksums of its documents: a list of a thousand addresses is not paired a thousand times.
    """
    each = found.select("key", "rows", F.explode("base").alias("span")).select("key", "rows", _entity(F.col("span")).alias("entity")).distinct()
    sums = [F.bit_xor(F.xxhash64("key", F.lit(seed))) for seed in (1, 2)]
    entities = each.groupBy("entity").agg(F.struct(*[s.alias(f"sum{i}") for i, s in enumerate(sums)]).alias("group"), F.sum("rows").alias("with_entity"))
    return each.join(entities, "entity").select("key", "rows", "group", "with_entity").distinct()


def _revealing(words: DataFrame, found: DataFrame, texts: DataFrame, *, generalise: float, remove: float, disclosure: float, bits: float) -> DataFrame:
    """``key``, ``term``, ``action``: the terms of a document that say too much about one of its entities.

    Of the documents with the term, a share holds the entity. Its logarithm over the entity's own share of
    the corpus, which terms of any frequency reach by chance, is the pointwise mutual information in
    bits. The term discloses that part of the entity's whole information, so the size of the corpus
    cancels out. The part is smoothed by n / (n + 1) for n mentions in different texts: a word
    mentioned once gives half at most, however rare it is; copies of one text are one piece of evidence.
    By chance as many different texts with the term hold the entity with a probability of less than 2^-``bits``.
    """
    terms = F.explode(F.array_distinct(F.transform(F.split("text", _NOT_TERM), F.lower))).alias("term")
    frequency = texts.select(terms).groupBy("term").agg(F.count("*").alias("with_term"))
    holders = materialized(_holders(found), "holders")
    # A term in many more documents than an entity cannot reach the share.
    most = F.broadcast(holders.agg(F.max("with_entity").alias("most")))  # one row
    frequency = frequency.crossJoin(most).where(F.col("with_term") * generalise <= F.col("most")).drop("most")
    rare = words.groupBy("key", "term").agg(F.count("*").alias("mentions")).join(frequency, "term")
    pairs = materialized(rare.join(holders, "key").where(F.col("with_term") * generalise <= F.col("with_entity")), "pairs")
    frequencies = [F.first(c).alias(c) for c in ("with_term", "with_entity")]
    told = pairs.groupBy("group", "term", F.col("key.hash").alias("hash")).agg(F.sum("rows").alias("rows"), F.first("mentions").alias("mentions"), *frequencies)
    told = told.groupBy("group", "term").agg(
        F.sum("rows").alias("together"), F.sum("mentions").alias("n"), F.count("*").alias("texts"), *frequencies)
    n_docs = texts.agg(F.count("*").alias("n_docs"))
    told = told.crossJoin(F.broadcast(n_docs))  # one row
    share = F.col("together") / F.col("with_term")
    whole = F.log2(F.col("n_docs") / F.col("with_entity"))
    part = F.try_divide(whole + F.log2(share), whole) * F.col("n") / (F.col("n") + 1)
    told = told.where((share >= generalise) & (part >= disclosure) & (whole * F.col("texts") >= bits))
    told = told.select("group", "term", F.when(share >= remove, "remove").otherwise("generalise").alias("action"))
    return pairs.join(told, ["group", "term"]).groupBy("key", "term").agg(F.max("action").alias("action"))


def find_personal_data(
    docs: DataFrame,
    *,
    generalise: float = 0.5,
    remove: float = 0.8,
    disclosure: float = 0.6,
    bits: float = 4.0,
) -> DataFrame:
    """All columns of ``docs``, and ``pii_spans``: ``start``, ``rank``, ``end``, ``kind``, ``action``, sorted.

    Base kinds are found by pattern, leftmost and non-overlapping per kind; a match that fails its
    check is dropped. Terms anywhere in a document with base spans are added (kind ``term``), at
    each of their occurrences in it, where the corpus shows that they disclose an entity of the
    document: of the documents with the term a share of ``generalise`` (``remove``) or more hold
    the entity, that gives away at least the part ``disclosure`` of its information, and chance
    would do so less than once in 2^``bits`` times. A word that is mentioned once beside the entity, and
    nowhere else, tells nothing: it stays, at any size of the corpus. Positions are code points, the
    end exclusive.

    Null and empty texts have no spans; very long texts and digit runs are read whole. Repeated
    rows, with equal or null ``doc_id`` too, are rows of their own with spans of their own, though
    equal texts are one piece of evidence. Of other columns a former ``pii_spans`` is replaced, the rest is
    kept. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The row is known by id and text: rows alike in both have the same spans.
    rows = rows.select(F.struct("doc_id", F.xxhash64("text").alias("hash"), F.length("text").alias("length")).alias("key"), "text")
    found = rows.where(F.col("text").rlike(_MAYBE)).select("key", base_spans(F.col("text")).alias("base"), "text").where(F.size("base") > 0)
    found = materialized(found.groupBy("key").agg(F.first("base").alias("base"), F.first("text").alias("text"), F.count("*").alias("rows")), "base")
    # A text gives many terms, so texts are dealt out first: the staged files are small.
    words = materialized(_words(found.repartition(width(docs.sparkSession), "key")), "words")
    telling = _revealing(words, found, rows, generalise=generalise, remove=remove, disclosure=disclosure, bits=bits)
    term_spans = words.join(telling, ["key", "term"])
    rank, kind = F.lit(len(KINDS)).alias("rank"), F.lit(TERM).alias("kind")
    terms = term_spans.groupBy("key").agg(F.collect_list(F.struct("start", rank, "end", kind, "action")).alias("terms"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), F.lit("remove").alias("action")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,action:string>>")
    spans = found.select("key", plain.alias("plain")).join(terms, "key", "left").select(
        F.col("key.doc_id").alias("pii_id"), F.col("key.hash").alias("pii_hash"), F.col("key.length").alias("pii_length"),
        F.array_sort(F.concat("plain", F.coalesce("terms", none))).alias("pii_spans"),
    )
    kept = docs.drop("pii_spans")
    text = F.coalesce(kept["text"], F.lit(""))
    same = kept["doc_id"].eqNullSafe(spans["pii_id"]) & (F.xxhash64(text) == spans["pii_hash"]) & (F.length(text) == spans["pii_length"])
    return kept.join(spans, same, "left").select(*[kept[c] for c in kept.columns], F.coalesce("pii_spans", none).alias("pii_spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with its spans replaced: ``[EMAIL]`` and so on; a generalised term keeps its first letter.

    Spans that overlap are replaced as one, by the mark of the first. Null stays null.
    """
    first = spans[0]
    start = F.struct(
        F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,action:string>>").alias("done"), first.alias("now"))

    def merge(state: Column, span: Column) -> Column:
        now = state["now"]
        inside = span["start"] < now["end"]
        wider = F.struct(now["start"].alias("start"), now["rank"].alias("rank"), F.greatest(now["end"], span["end"]).alias("end"), now["kind"].alias("kind"), now["action"].alias("action"))
        return F.struct(
            F.when(inside, state["done"]).otherwise(F.concat(state["done"], F.array(now))).alias("done"),
            F.when(inside, wider).otherwise(span).alias("now"),
        )

    merged = F.aggregate(F.slice(spans, 2, F.size(spans)), start, merge, lambda s: F.concat(s["done"], F.array(s["now"])))
    ends = F.transform(merged, lambda s: s["end"])

    def piece(span: Column, place: Column) -> Column:
        at = F.when(place == 0, 0).otherwise(F.get(ends, place - 1))
        letter = F.concat(F.substring(text, span["start"] + 1, F.lit(1)), F.lit("."))
        mark = F.when(span["action"] == "generalise", letter).otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        return F.concat(F.substring(text, at + 1, span["start"] - at), mark)

    rest = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(F.transform(merged, piece), ""), rest))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
