"""Broken prompt and response pairs: empty, truncated, refused, copied, wrong language.

Refusals are found by what repeats, without any list of phrases. An opening is a
run of OPENING words near the start of an answer, at each of its first words (a
courtesy may come before the template), with the words of the own question
masked. Openings that are one another but for one shingle are linked by equal keys,
exactly, and what is connected is a cluster; a cluster that recurs across unrelated
prompts, in an answer written in words that answers use far more than tasks do,
is a template of declining, not an answer. Truncation is found by how texts of
this corpus end. All counts are over the whole tables and all thresholds are
shares of them, with a floor for small tables.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskmill.llm.keep_together import spanning_forest
from taskmill.llm.words import words
from taskmill.runtime import stored

#: Words of an opening, and in how many places at the start of an answer one begins.
OPENING, PLACES = 6, 18
#: Openings with fewer words of their own, the question's masked, tell nothing.
OWN_WORDS = 3
#: Words of a shingle, and the share of the shingles of the larger of two openings that both need.
SHINGLE, SIMILARITY = 5, 0.8
#: Unrelated prompts that an opening or a word must recur across: a share of the prompts
#: that have an answer in free text, and a floor.
RECURS_SHARE, RECURS_LEAST = 0.0003, 3
#: What two openings of a cluster have in common recurs across one in so many of the prompts that
#: a cluster needs, and two at least, or chance would chain more openings as tables grow.
LINK_ONE_IN, LINK_LEAST = 3, 2
#: A word is foreign to tasks if its share among answers is so many times that among tasks.
LIFT = 10
#: Share of an answer's words that are foreign to tasks yet recur in answers.
FOREIGN = 0.3
COPY_RECALL = 0.75
#: A task with more than one in so many responses is joined by broadcast; there are at most so many.
HOT_ONE_IN = 1000
#: A word ends sentences if its share among last words is at least this part of its share among texts.
ENDS, SUFFIX_SHARE = 0.005, 0.01
#: Share of all last words, and number, that a word needs to be known as one.
ENDS_SHARE, ENDS_LEAST = 2e-6, 2

# Fillers that say nothing, as words.
FILLERS = ["null", "none", "n a", "na", "nan", "nil", "tbd", "todo", "answer", "undefined", "unknown", "empty", "no answer", "your answer", "placeholder", "xxx"]

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and that which by with from for its every most when what who why how is are were to each some between than this",
    "es": "el la los las de que en por con una un del y también porque cuando aunque durante mientras más después según nadie cuál qué sobre hacia desde",
    "fr": "le la les de des du que une un et dans pour par pendant depuis quand même personne déjà sur sous derrière vers quelle pourquoi était à près",
    "de": "der die das und von den dem mit für ist es nicht auf seit während heute gestern später hinter unter wer was warum laut sobald nachdem kaum gegen heißt dort",
}

_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_HAN, _CYRILLIC = re.compile("[一-鿿]"), re.compile("[Ѐ-ӿ]")
_TERMINATED = re.compile(r"[.!?…。！？][\"'»”’)\]]*\s*$")
_STOPS = re.compile(r"[.!?…。！？]+")
_FENCE = re.compile(r"^```\w*\s*|\s*```$")


def language(ws: list[str], text: str) -> tuple[str | None, dict[str, int]]:
    """(language or null, hits by language) from script and function words."""
    letters = max(1, sum(map(len, ws)))
    if len(_HAN.findall(text)) * 3 > letters:
        return "zh", {}
    if len(_CYRILLIC.findall(text)) * 3 > letters:
        return "ru", {}
    hits = {k: sum(w in s for w in ws) for k, s in _SETS.items()}
    best = max(hits, key=hits.__getitem__)
    second = max(v for k, v in hits.items() if k != best)
    return (best if hits[best] >= 2 and hits[best] > second else None), hits


def other_language(q: str, a: str) -> bool:
    """Whether text a is clearly in another language than q."""
    qw, aw = words(q), words(a)
    lq, _ = language(qw, q)
    la, hits = language(aw, a)
    if lq is None or la == lq:
        return False
    if "zh" in (la, lq) or "ru" in (la, lq):
        return la is not None
    most = max(hits.values())  # two languages may tie; what counts is that the question's is far behind
    return most >= 2 and most > 1.5 * hits[lq]


def raw_is_open(raw: str | None) -> bool:
    """Whether a response that began a JSON object never closed it."""
    s = _FENCE.sub("", (raw or "").strip()).strip()
    return s.startswith("{") and not s.endswith("}")


def _tail(text: str | None) -> str | None:
    """Last word of a text that does not end with a stop, or null."""
    s = (text or "").strip()
    if not s or _TERMINATED.search(s):
        return None
    ws = words(s)
    return ws[-1] if ws else None


def openings(ws: list[str], question: frozenset[str]) -> list[str]:
    """The distinct openings of an answer, question words masked."""
    masked = ["_" if w in question else w for w in ws[: OPENING + PLACES]]
    last = max(1, min(PLACES, len(masked) - SHINGLE + 1))
    runs = (masked[i : i + OPENING] for i in range(last))
    return sorted({" ".join(r) for r in runs if len(r) - r.count("_") >= OWN_WORDS})


_FEATURES = (
    "response_id bigint, prompt bigint, empty boolean, copy boolean, foreign_language boolean, raw_open boolean, prefix boolean, candidate boolean, "
    "openings array<string>, answer_words array<string>, tails array<string>, finals array<string>"
)


def features(r: dict) -> dict:
    """What one response says about itself, next to its task."""
    import xxhash

    fa = r["final_answer"] or ""
    fw = words(fa)
    fn = " ".join(fw)
    question = r["question_text"] or ""
    qw = words(question)
    options = {" ".join(words(x)) for x in [*(r["choices"] or []), r["reference_answer"], *(r["reference_aliases"] or [])] if x}
    options.discard("")
    known = fn in options
    empty = not known and (not fw or fn in FILLERS)
    said = (r["raw_response"] or "") if empty and not fw else fa
    sw = words(said) if said is not fa else fw
    if qw and fw and not known:
        left = Counter(qw)
        common = sum(min(c, left[w]) for w, c in Counter(fw).items())
        copy = len(qw) >= 3 and common >= COPY_RECALL * len(qw)
    else:
        copy = False
    foreign = False
    if fw and qw and not known and other_language(question, fa):
        why = r["reasoning"] or ""
        foreign = not words(why) or other_language(question, why)
    prefix = bool(fw) and not known and not empty and not fn.isdigit() and any(o.startswith(fn) for o in options)
    # A raw text around an object whose answer is empty is its wrapping, no saying.
    wrapped = "{" in said if said is not fa else said.lstrip().startswith(("{", "```"))
    candidate = not known and not copy and len(sw) >= 3 and not wrapped
    tails = []
    if not r["raw_open"] and not empty:
        if (t := _tail(r["reasoning"])) is not None:
            tails.append(t)
        if not known and not copy and (t := _tail(fa)) is not None:
            tails.append(t)
    finals = [w[-1] for t in (r["reasoning"], question) for s in _STOPS.split(t or "")[:-1] if (w := words(s))] + [o.rsplit(" ", 1)[-1] for o in options]
    return {
        "response_id": r["response_id"], "prompt": xxhash.xxh64_intdigest(" ".join(qw)) - (1 << 63), "empty": empty, "copy": copy, "foreign_language": foreign,
        "raw_open": bool(r["raw_open"]), "prefix": prefix, "candidate": candidate,
        "openings": openings(sw, frozenset(qw)) if candidate else None, "answer_words": sorted(set(sw) - set(qw)) if candidate else None, "tails": tails, "finals": finals,
    }


def _paired(responses: DataFrame, tasks: DataFrame) -> DataFrame:
    """Responses with their task. Tasks that hold many responses are few and go by
    broadcast, the rest by a shuffle in which no key is hot."""
    opened = F.regexp_replace(F.trim("raw_response"), r"^```\w*\s*", "")
    opened = F.trim(F.regexp_replace(opened, r"\s*```\s*$", ""))
    raw_open = opened.startswith("{") & ~F.regexp_replace(opened, r"[\s]+$", "").endswith("}")
    wordless = ~F.coalesce(F.col("final_answer"), F.lit("")).rlike(r"[\p{L}\p{N}]")
    r = responses.select(
        F.col("response_id").cast("bigint").alias("response_id"), F.col("task_key").cast("bigint").alias("task_key"), "final_answer", "reasoning",
        F.coalesce(raw_open, F.lit(False)).alias("raw_open"), F.when(wordless, F.col("raw_response")).alias("raw_response"),
    ).filter("response_id IS NOT NULL")
    t = tasks.select(F.col("task_key").cast("bigint").alias("task_key"), "question_text", "choices", "reference_answer", "reference_aliases")
    counts = responses.select(F.col("task_key").cast("bigint").alias("task_key")).filter("task_key IS NOT NULL").groupBy("task_key").agg(F.count("*").alias("n"))
    total = responses.count()
    hot = [x[0] for x in counts.filter(F.col("n") > max(100, total // HOT_ONE_IN)).select("task_key").collect()]
    is_hot = F.col("task_key").isNull() | F.col("task_key").isin(hot)
    cold = r.filter(~is_hot).join(t.filter("task_key IS NOT NULL"), "task_key", "left")
    return cold.unionByName(r.filter(is_hot).join(F.broadcast(t.filter(F.col("task_key").isin(hot))), "task_key", "left"))


def clusters(texts: DataFrame, least: int = 0) -> DataFrame:
    """(opening, cluster) of distinct openings: connected by verified links.

    The shingles of an opening are its runs of SHINGLE words or, where it has too few
    of those for one to be missing, its words with their places. Openings of equal
    shingles are one set. Two sets are SIMILARITY alike exactly if they are equal
    but for one shingle of either or both, i.e. if they have a key in common: the hash
    of a set or of a set less one shingle, OWN_WORDS words that are not masked being
    left. All sets of a key are alike, so each is linked to the smallest one, no link
    is lost and a common key makes no pairs. Where texts have a ``prompt``, keys of
    fewer than ``least`` prompts link nothing.
    """
    assert max(OPENING - SHINGLE + 1, SHINGLE + 3) - 2 < SIMILARITY * max(OPENING - SHINGLE + 1, SHINGLE + 3)
    ws = F.split("opening", " ")
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(ws) - SHINGLE, F.lit(0))), lambda i: F.xxhash64(F.array_join(F.slice(ws, i + 1, SHINGLE), " ")))
    few = F.size(runs) - 1 < SIMILARITY * F.size(runs)
    placed = F.transform(ws, lambda w, i: F.xxhash64(i, w))
    unmasked = F.size(F.filter(ws, lambda w: w != "_"))
    # A word may be missing if enough unmasked ones are left without it.
    spare = F.filter(placed, lambda g, i: (F.get(ws, i) == "_") | (unmasked > OWN_WORDS))
    prompt = ["prompt"] if "prompt" in texts.columns else []
    grams = texts.select("opening", *prompt, F.array_sort(F.array_distinct(F.when(few, placed).otherwise(runs))).alias("grams"), F.when(few, spare).otherwise(runs).alias("spare"))
    alike = F.size("grams") - 1 >= SIMILARITY * F.size("grams")
    less = F.when(alike, F.transform("spare", lambda g: F.xxhash64(F.array_remove("grams", g)))).otherwise(F.array().cast("array<bigint>"))
    keyed = grams.select("opening", *prompt, F.xxhash64("grams").alias("own"), less.alias("less"))
    met = keyed.select("own", *prompt, F.explode(F.concat(F.array("own"), "less")).alias("key")).distinct()
    heads = met.groupBy("key").agg(F.min("own").alias("v"), F.max("own").alias("w"), F.count_distinct(*prompt or ["own"]).alias("n"))
    heads = heads.filter(F.col("v") < F.col("w")).filter(F.col("n") >= (least if prompt else 0)).select("key", "v")
    edges = met.join(heads, "key").select(F.col("own").alias("u"), "v").distinct()
    labels = spanning_forest(edges).labels
    openings_of = keyed.select("opening", "own").distinct()
    return openings_of.join(labels, openings_of.own == labels.node, "left").select("opening", F.coalesce("root", "own").alias("cluster"))


def _refusals(feats: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(response_id) of answers with an opening that is a recurring template of declining."""
    cand = feats.filter("candidate").select("response_id", "prompt", "openings", "answer_words")
    prompts = cand.select("prompt").distinct().count()
    least = max(RECURS_LEAST, round(RECURS_SHARE * prompts))
    said = cand.select("response_id", "prompt", F.explode("openings").alias("opening"))
    member = clusters(stored(said.select("opening", "prompt").distinct()), max(LINK_LEAST, least // LINK_ONE_IN))
    heard = said.join(member, "opening").select("response_id", "prompt", "cluster")
    recurs = heard.groupBy("cluster").agg(F.count_distinct("prompt").alias("recurs")).filter(F.col("recurs") >= least).select("cluster")
    template = heard.join(recurs, "cluster", "left_semi").select("response_id").distinct()
    # Words that recur in answers to unrelated prompts but are foreign to the tasks.
    used = cand.select("response_id", "prompt", F.explode("answer_words").alias("word"))
    spread = used.groupBy("word").agg(F.count_distinct("prompt").alias("n")).filter(F.col("n") >= least)
    lift = F.col("n") / max(1, prompts) >= LIFT * F.coalesce("share", F.lit(0.0))
    register = spread.join(vocabulary, "word", "left").filter(lift).select("word")
    part = used.join(register, "word", "left_semi").groupBy("response_id").agg(F.count("*").alias("foreign_words"))
    judged = cand.join(template, "response_id", "left_semi").join(part, "response_id")
    return judged.filter(F.col("foreign_words") >= FOREIGN * F.size("answer_words")).select("response_id").distinct()


def defects(responses: DataFrame, tasks: DataFrame) -> DataFrame:
    """(response_id, defect): one row per defective response, with one defect.

    In this order: refusal, empty_answer, question_copy, other_language,
    truncated_answer. A final answer that is one of the task's choices, its
    reference or an alias is never refused, copied or foreign. Null texts count
    as empty; a response without a known task is judged by its own texts;
    responses delivered again are judged each; empty tables give no rows. A refusal
    in a wording of its own, which recurs nowhere, cannot be told from an answer.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for b in batches:
            schema = schema or pa.schema(
                [("response_id", pa.int64()), ("prompt", pa.int64()), *[(c, pa.bool_()) for c in ("empty", "copy", "foreign_language", "raw_open", "prefix", "candidate")],
                 *[(c, pa.list_(pa.string())) for c in ("openings", "answer_words", "tails", "finals")]]
            )
            yield pa.RecordBatch.from_pylist([features(x) for x in b.to_pylist()], schema)

    feats = stored(_paired(responses, tasks).mapInArrow(run, _FEATURES))
    text = F.concat_ws(" ", "question_text", F.array_join(F.coalesce("choices", F.array().cast("array<string>")), " "), "reference_answer", F.array_join(F.coalesce("reference_aliases", F.array().cast("array<string>")), " "))
    n_tasks = F.lit(max(1, tasks.count()))
    spoken = tasks.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("word"))
    vocabulary = spoken.groupBy("word").agg(F.count("*").alias("texts")).withColumn("share", F.col("texts") / n_tasks)
    refused = _refusals(feats, vocabulary)

    finals = feats.select(F.explode("finals").alias("word"))
    ends = finals.groupBy("word").agg(F.count("*").alias("n_final"))
    totals = ends.agg(F.sum("n_final")).first()[0] or 1
    suffixes = [
        x[0] for x in ends.groupBy(F.substring("word", -3, 3).alias("s")).agg(F.sum("n_final").alias("n")).filter(F.col("n") >= SUFFIX_SHARE * totals).select("s").collect()
    ]  # at most 1 / SUFFIX_SHARE
    tails = feats.filter(F.size("tails") > 0).select("response_id", F.explode("tails").alias("word"))
    seen = tails.join(ends, "word", "left").join(vocabulary.select("word", "texts", "share"), "word", "left")
    rate = (F.col("n_final") / F.lit(float(totals))) / F.coalesce("share", F.lit(1e-9))
    ends_texts = (F.coalesce("n_final", F.lit(0)) >= max(ENDS_LEAST, round(ENDS_SHARE * totals))) & (rate >= ENDS)
    named = F.col("texts").isNull() & (F.length("word") >= 5) & F.substring("word", -3, 3).isin(suffixes)
    option_word = F.coalesce("n_final", F.lit(0)).eqNullSafe(0) & (F.coalesce("texts", F.lit(0)) >= 2) & F.col("word").rlike(r"\p{N}")
    cut_off = seen.filter(~(ends_texts | named | option_word)).select("response_id").distinct()

    out = feats.select("response_id", "empty", "copy", "foreign_language", "raw_open", "prefix")
    out = out.join(refused.withColumn("refused", F.lit(True)), "response_id", "left").join(cut_off.withColumn("cut_off", F.lit(True)), "response_id", "left")
    defect = (
        F.when(F.col("refused"), "refusal")
        .when(F.col("empty"), "empty_answer")
        .when(F.col("copy"), "question_copy")
        .when(F.col("foreign_language"), "other_language")
        .when(F.col("raw_open") | F.col("prefix") | F.coalesce("cut_off", F.lit(False)), "truncated_answer")
    )
    return out.select("response_id", defect.alias("defect")).filter("defect IS NOT NULL").distinct()
