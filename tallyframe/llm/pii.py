"""Personal data: fixed patterns, then bootstrapped contextual extraction.

Base spans come from patterns of e-mail addresses, IP addresses, card and phone
numbers. They are the seeds of a graph between instances (values of base spans,
and words with digits that are no base span) and lexical patterns (the word
before, the word after). Identifiers that look like secrets, long and mixed of letters and
digits, are seeds of a lower score, so that the words beside them become patterns
too. In each round a pattern's confidence is the instances'
mean score over all occurrences of its word in the corpus, and an instance's
score is the noisy-or of the confident patterns it is found in. Patterns need
several distinct instances. Words that end with a high score are further spans.

All of it is DataFrame expressions and joins. The corpus-wide word counts and
the graph are aggregated before they are shuffled, so a common word is no hot
key. Positions are in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import (
    NO_ID,
    by_own_names,
    id_back,
    id_of,
    set_apart,
    whole_text,
    write_out,
)

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: A search may start where the last one ended or where a run starts. Starts inside a run
#: would match if and only if its start does, but would make long runs quadratic.
KINDS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
BLANK = r"\x20\x09-\x0D"
#: Words with a digit, found by their first character.
DIGIT_WORD = rf"(?<![^{BLANK}])[^{BLANK}0-9]*+[0-9][^{BLANK}]*+"
#: Words of patterns end at blanks and at these, in contexts and in counts alike.
PUNCTUATION = r"""[.,;:!?"'()\[\]{}<>=#|*/\\&~`"""
BETWEEN = rf"{PUNCTUATION}{BLANK}]"
NUMBERLESS = rf"[^0-9{PUNCTUATION[1:]}]"
#: Labels glued to the front of a word with digits.
LABELS = rf"^(?:{NUMBERLESS}*+{PUNCTUATION}]++)*+"

#: Identifiers of this form are taken for secrets until their contexts say otherwise: as seeds
#: they make patterns like others, but are spans only where a pattern finds them.
SECRET = r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_-]{32,}$"
PRIOR = 0.9

#: Scores settle long before; no more rounds than these.
ROUNDS = 20
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.5
MIN_SCORE = 0.8
#: Code points in which the neighbouring word is looked for before all that lies between is.
REACH = 64
BLOCK = 512
CONTEXT = "context"

PLACE = "struct<start:int,end:int>"


def _words(part: Column) -> Column:
    return F.array_remove(F.split(part, f"{BETWEEN}+"), "")


def _word(part: Column, last: bool) -> Column:
    """The nearest whole word of a neighbouring stretch of text, without case."""
    near = F.right(part, F.lit(REACH)) if last else F.left(part, F.lit(REACH))
    at = F.lit(-1 if last else 1)
    # The only word within reach may go on beyond it.
    whole = (F.length(part) <= REACH) | (F.size(_words(near)) > 1)
    word = F.when(whole, F.try_element_at(_words(near), at)).otherwise(F.try_element_at(_words(part), at))
    return F.coalesce(F.lower(word), F.lit(""))


def _glued(part: Column, last: bool) -> Column:
    """Whether nothing parts the neighbouring word from the span, so that the span cuts it off."""
    beside = F.right(part, F.lit(1)) if last else F.left(part, F.lit(1))
    return beside.rlike(BETWEEN.replace("[", "[^", 1))


def _running(steps: Column, out_type: str) -> Column:
    """Start and end of each (gap, len) step, counted from the first one."""

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["len"]
        here = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(here)).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{out_type}>").alias("out"))
    return F.aggregate(steps, first, add, lambda state: state["out"])


def with_matches(
    docs: DataFrame, name: str, pattern: str, guard: Column, parted: bool = False
) -> DataFrame:
    """Add ``name``: start, end, value and neighbouring words of all matches in ``text``.

    What lies between matches is split off, and positions are running sums of
    lengths, in blocks, so that no array is built up over all matches.
    ``parted`` says that matches are no part of words wherever they are counted.
    """

    def cut(gap: Column, last: bool, bounded: Column) -> Column:
        """Whether the word is a piece that a match has cut off, this one or the next."""
        if parted:
            return F.lit(False)
        across = bounded & _glued(gap, not last) & (F.size(_words(gap)) == 1)
        return _glued(gap, last) | across

    text, found, gaps = whole_text(), F.col("_found"), F.col("_gaps")
    none = F.array().cast("array<string>")
    all_of = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    here = docs.withColumn("_found", F.when(guard, all_of).otherwise(none))
    some = F.size("_found") > 0
    here = here.withColumn("_gaps", F.when(some, F.split(text, pattern, -1)).otherwise(none))
    steps = F.transform(
        "_found",
        lambda m, i: F.struct(
            F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("len")
        ),
    )
    here = here.withColumn("_steps", steps)
    blocks = F.transform(
        F.sequence(F.lit(0), F.size("_found") - 1, F.lit(BLOCK)),
        lambda at: F.slice("_steps", at + 1, BLOCK),
    )
    no_blocks = F.array().cast("array<array<struct<gap:int,len:int>>>")
    here = here.withColumn("_blocks", F.when(some, blocks).otherwise(no_blocks))
    total = F.transform(
        "_blocks",
        lambda b: F.struct(
            F.lit(0).alias("gap"),
            F.aggregate(b, F.lit(0), lambda a, x: a + x["gap"] + x["len"]).alias("len"),
        ),
    )
    here = here.withColumn("_offsets", _running(total, PLACE))
    places = F.transform(
        "_blocks",
        lambda b, k: F.transform(
            _running(b, PLACE),
            lambda x: F.struct(
                (x["start"] + F.get("_offsets", k)["start"]).alias("start"),
                (x["end"] + F.get("_offsets", k)["start"]).alias("end"),
            ),
        ),
    )
    here = here.withColumn("_places", F.flatten(places))
    spans = F.transform(
        "_places",
        lambda p, i: F.struct(
            p["start"].alias("start"),
            p["end"].alias("end"),
            F.get(found, i).alias("value"),
            _word(F.get(gaps, i), last=True).alias("left"),
            _word(F.get(gaps, i + 1), last=False).alias("right"),
            cut(F.get(gaps, i), True, i > 0).alias("left_cut"),
            cut(F.get(gaps, i + 1), False, i + 1 < F.size(found)).alias("right_cut"),
        ),
    )
    here = here.withColumn(name, spans)
    return here.drop("_found", "_gaps", "_steps", "_blocks", "_offsets", "_places")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def digit(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + digit(i))
    return total % 10 == 0


def _validity(kind: str):
    return lambda span: _valid(kind, span["value"])


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Add an array of spans for each kind, ``_email`` to ``_phone``."""
    text = whole_text()
    guards = {
        "email": text.contains("@"),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": text.contains("+"),
    }
    for kind, pattern in KINDS.items():
        docs = with_matches(docs, "_all", pattern, guards[kind], parted=kind == "email")
        kept = F.filter("_all", _validity(kind))
        docs = docs.withColumn(f"_{kind}", kept).drop("_all")
    return docs


def _written(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")),
    )


def find_base(docs: DataFrame) -> DataFrame:
    """(_row, _id, _text, n_*, base, seeds, words) of every row; written, so that rows keep their number."""
    here = with_base_spans(docs.select(id_of().alias("_id"), "text"))
    here = with_matches(here, "_digits", DIGIT_WORD, whole_text().rlike("[0-9]"))
    base = F.concat(*[_written(kind, F.col(f"_{kind}")) for kind in KINDS])
    return write_out(
        here.select(
            F.monotonically_increasing_id().alias("_row"),
            F.xxhash64(whole_text()).alias("_text"),
            "_id",
            *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
            F.array_join(base, ",").alias("base"),
            F.concat(*[f"_{kind}" for kind in KINDS]).alias("seeds"),
            F.col("_digits").alias("words"),
        ),
        "base-spans",
    )


def _identifiers(found: DataFrame) -> DataFrame:
    """Words with digits that look like identifiers and touch no base span, one a row."""
    word = found.select("_row", F.explode("words").alias("w")).select("_row", "w.*")
    labels = F.length(F.regexp_extract("value", LABELS, 0))
    # Without the labels before it, and with no more than its own piece after the last digit.
    rest = F.regexp_extract(F.substring("value", labels + 1, F.length("value")),
                            f"^(?s:.*)[0-9]{NUMBERLESS}*+", 0)
    lead = labels + F.length(F.regexp_extract(rest, "^[^A-Za-z0-9+]*+", 0))
    core = F.regexp_extract(rest, "[A-Za-z0-9+](?s:.*[A-Za-z0-9])?", 0)
    before = F.substring("value", F.lit(1), lead)
    after = F.substring("value", lead + F.length(core) + 1, F.length("value"))
    near, next_ = _word(before, last=True), _word(after, last=False)
    word = word.select(
        "_row",
        (F.col("start") + lead).alias("start"),
        (F.col("start") + lead + F.length(core)).alias("end"),
        core.alias("value"),
        F.when(near != "", near).otherwise(F.col("left")).alias("left"),
        F.when(next_ != "", next_).otherwise(F.col("right")).alias("right"),
        _glued(before, last=True).alias("left_cut"),
        _glued(after, last=False).alias("right_cut"),
    )
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    word = word.filter((F.length("value") >= 6) & (digits >= 4))

    def cells(rows: DataFrame) -> DataFrame:
        first = F.floor(F.col("start") / REACH).cast("int")
        last = F.floor((F.col("end") - 1) / REACH).cast("int")
        return rows.withColumn("cell", F.explode(F.sequence(first, last)))

    seeds = found.select("_row", F.explode("seeds").alias("s")).select("_row", "s.start", "s.end")
    w, s = cells(word.select("_row", "start", "end")).alias("w"), cells(seeds).alias("s")
    touching = w.join(
        s,
        (F.col("w._row") == F.col("s._row"))
        & (F.col("w.cell") == F.col("s.cell"))
        & (F.col("w.start") < F.col("s.end"))
        & (F.col("s.start") < F.col("w.end")),
        "left_semi",
    )
    return word.join(touching.select("_row", "start").distinct(), ["_row", "start"], "left_anti")


def _contexts(spans: DataFrame) -> DataFrame:
    """(value, side, word, cut) of both sides of each span that have a word.

    Spans that start, or end, at one place have one context there.
    """

    def side(name: str, word: str, at: str) -> DataFrame:
        here = spans.filter(F.col(word) != "").groupBy("_row", at)
        first = here.agg(F.min(F.struct("value", word, f"{word}_cut")).alias("x")).select("x.*")
        return first.select("value", F.lit(name).alias("side"), F.col(word).alias("word"),
                            F.col(f"{word}_cut").alias("cut"))

    return side("before", "left", "start").union(side("after", "right", "end"))


def _edges(contexts: DataFrame) -> DataFrame:
    """(value, pattern, n): how often each value stands beside each pattern's word."""
    return contexts.groupBy("value", "side", "word").agg(F.count("*").alias("n"))


def word_counts(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """(word, total) over all words of the corpus, in the form that patterns use.

    E-mail addresses are no words, and part those beside them. What other spans cut
    off a word they are glued to counts as a word of its own.
    """
    text = whole_text()
    apart = F.when(text.contains("@"), F.regexp_replace(text, KINDS["email"], " ")).otherwise(text)
    words = docs.select(F.explode(_words(apart)).alias("w")).select(F.lower("w").alias("word"))
    words = words.union(contexts.filter("cut").select("word"))
    return words.groupBy("word").agg(F.count("*").alias("total"))


def bootstrap(
    docs: DataFrame,
    seeds: DataFrame,
    unseen: DataFrame,
    rounds: int = ROUNDS,
    min_support: int = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(value, score) of unseen values that stand in confident patterns.

    Rounds go on until the scores settle, and no further than ``rounds``.
    """
    beside_seeds = write_out(_contexts(seeds), "seed-contexts")
    beside_unseen = write_out(_contexts(unseen), "unseen-contexts")
    known = _edges(beside_seeds).withColumn("prior", F.lit(1.0))
    secret = F.when(F.col("value").rlike(SECRET), PRIOR).otherwise(0.0)
    edges = known.union(_edges(beside_unseen).withColumn("prior", secret))
    # Words beside no seed or candidate are never asked for; the others keep their corpus count.
    asked = edges.select("word").distinct()
    totals = word_counts(docs, beside_seeds.union(beside_unseen)).join(asked, "word", "left_semi")
    edges = write_out(edges.join(totals, "word"), "pattern-graph")
    # A value that is a base span anywhere is no unseen one.
    priors = write_out(edges.groupBy("value").agg(F.max("prior").alias("score")), "priors")
    scores, reached, before = priors.filter("score > 0"), None, None
    pattern = ["side", "word"]
    for _ in range(rounds):
        confident = (
            edges.join(scores, "value")
            .groupBy(*pattern)
            .agg(
                (F.sum(F.col("n") * F.col("score")) / F.max("total")).alias("confidence"),
                F.count_distinct("value").alias("support"),
            )
            .filter((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
            .select(*pattern, F.least("confidence", F.lit(0.999)).alias("confidence"))
        )
        found = (
            edges.join(confident, pattern)
            .groupBy("value")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("reached"))
        )
        reached = write_out(
            priors.join(found, "value", "left").select(
                "value", F.col("score").alias("prior"), F.coalesce("reached", F.lit(0.0)).alias("reached")
            ),
            "instance-scores",
        )
        now = reached.agg(F.sum(F.round("reached", 6)), F.count_if(F.col("reached") > 0)).first()
        if now == before:
            break
        before = now
        best = F.when(F.col("prior") == 1.0, 1.0).otherwise(F.greatest("prior", "reached"))
        scores = reached.select("value", best.alias("score")).filter("score > 0")
    return reached.filter("prior < 1 AND reached > 0").select("value", F.col("reached").alias("score"))


def find(docs: DataFrame, min_score: float = MIN_SCORE, **options: float) -> DataFrame:
    """One row a row of ``docs``: doc_id, n_email ... n_phone, n_context, base, spans, places, _text.

    ``base`` and ``spans`` are kind:start:end by kind and start; ``places`` are the
    same spans as (start, end) in order, and ``_text`` is a hash of the text. A null text has none; rows with null or
    repeated ids keep a row each; other columns are not looked at.
    """
    found = find_base(docs)
    seeds = found.select("_row", F.explode("seeds").alias("s")).select("_row", "s.*")
    unseen = write_out(_identifiers(found), "identifiers")
    scores = bootstrap(docs, seeds, unseen, **options).filter(F.col("score") >= min_score)
    extra = (
        unseen.join(scores, "value")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("extra"))
    )
    here = found.drop("words").join(extra, "_row", "left")
    none = F.array().cast(f"array<{PLACE}>")
    here = here.withColumn("extra", F.coalesce("extra", none))
    more = F.array_join(_written(CONTEXT, F.col("extra")), ",")
    base = F.when(F.col("base") != "", F.col("base"))
    place = F.transform("seeds", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return here.select(
        id_back(F.col("_id")).alias("doc_id"),
        "_text",
        *[f"n_{kind}" for kind in KINDS],
        F.size("extra").cast("long").alias("n_context"),
        "base",
        F.concat_ws(",", base, F.when(F.size("extra") > 0, more)).alias("spans"),
        F.sort_array(F.concat(place, "extra")).alias("places"),
    )


def redact(docs: DataFrame, mark: str = "[PRIVATE]", **options: float) -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans by one mark.

    Texts without spans, null ones too, stay as they are. A column ``n_chars``
    gets the new length; all columns keep their names and types.
    """
    columns, kind = docs.columns, dict(docs.dtypes).get("n_chars")
    docs, back = set_apart(docs, ["doc_id", "text", "n_chars"])
    found = find(docs.select("doc_id", "text"), **options).filter(F.size("places") > 0)
    places = found.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), "_text", "places"
    ).dropDuplicates(["_id", "_text"])
    keyed = docs.withColumn("_id", id_of()).withColumn("_text", F.xxhash64(whole_text()))
    here = keyed.join(places, ["_id", "_text"], "left")

    def step(state: Column, x: Column) -> Column:
        gap = F.substring("text", state["at"] + 1, F.greatest(x["start"] - state["at"], F.lit(0)))
        apart = x["start"] >= state["at"]
        out = F.when(apart, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(x["end"], state["at"]).alias("at"), out.alias("out"))

    def end(state: Column) -> Column:
        return F.concat(state["out"], F.substring("text", state["at"] + 1, F.length("text")))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.when(F.col("places").isNull(), F.col("text")).otherwise(
        F.aggregate("places", first, step, end)
    )
    changed = here.withColumn("_new", new)
    back["text"] = F.col("_new")
    if "n_chars" in columns:
        size = F.when(F.col("places").isNull(), F.col("n_chars")).otherwise(F.length("_new"))
        back["n_chars"] = size.cast(kind)
    return changed.select(*by_own_names({c: back[c] for c in columns}))
