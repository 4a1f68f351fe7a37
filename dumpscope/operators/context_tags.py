"""Part-of-speech tags in context: a bigram tag model counted from a tagged table, Viterbi over each sentence.

The model is two grouped counts over a tagged table (``sentence``, ``pos``, ``word``, ``tag``): of (previous tag, tag),
the first tag of a sentence following ``START``, and of (word, tag). Probabilities are add-one smoothed:
``P(t | p) = (c(p, t) + 1) / (c(p) + T)`` with T the tags (``UNKNOWN`` among them) and
``P(w | t) = (c(w, t) + 1) / (c(t) + V)`` with V the distinct words of the table.

The tags that a word may take come from a lexicon of (``word``, ``tag``) rows, several for a word; a word that the
lexicon does not know has the one tag ``UNKNOWN`` with an emission of probability 1. Each text's tokens find their
candidates (tag, log emission, in tag order) by ``looked_up``: where the text lies for a lexicon of at most ``limit``
words, else by a join. A text is one list of tokens with a null behind each sentence, and one row throughout. ``tagger``
goes over that list once, inside Arrow batches: for each candidate of a token it keeps the best log score of a tag path
that ends there and the predecessor it came from (ties: the earlier in tag order), and at the end of a sentence it
follows the predecessors back from the best last candidate (ties: the earlier). So a sentence costs its length. The
transition table has at most T * T entries, as T is checked against ``MAX_TAGS``.

Texts are cut into sentences after ``.``, ``!`` or ``?`` and whitespace, and sentences into whitespace tokens; null and
empty texts give empty lists, rows with equal or null keys stay apart, and extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dumpscope.functions import text as tx
from dumpscope.operators.lookup import looked_up
from dumpscope.operators.small import INLINE_LIMIT

START, UNKNOWN = "<s>", "X"
#: Tag sets larger than this are not a closed class; the transition map would not be bounded.
MAX_TAGS = 256


def transitions(tagged: DataFrame) -> dict[str, float]:
    """``"previous tag"`` + ``" "`` + ``"tag"`` to its log probability, and each previous tag alone to that of an unseen pair."""
    order = Window.partitionBy("sentence").orderBy("pos")
    pairs = tagged.select(F.coalesce(F.lag("tag").over(order), F.lit(START)).alias("prev"), "tag")
    counts = pairs.groupBy("prev", "tag").count()
    tags = {r["tag"] for r in tagged.select("tag").distinct().limit(MAX_TAGS + 1).collect()} | {UNKNOWN}
    if len(tags) > MAX_TAGS:
        raise ValueError(f"more than {MAX_TAGS} tags: not a closed class")
    rows = counts.collect()
    total: dict[str, int] = {}
    for r in rows:
        total[r["prev"]] = total.get(r["prev"], 0) + r["count"]
    out = {p: math.log(1 / (total.get(p, 0) + len(tags))) for p in tags | {START}}
    for r in rows:
        out[f"{r['prev']} {r['tag']}"] = math.log((r["count"] + 1) / (total[r["prev"]] + len(tags)))
    return out


def candidates(lexicon: DataFrame, tagged: DataFrame) -> DataFrame:
    """``_word``, ``_cands``: each lexicon word's tags with their log emission, in tag order."""
    words = tagged.groupBy("word", "tag").agg(F.count(F.lit(1)).alias("c"))
    per_tag = tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("ct"))
    vocabulary = tagged.agg(F.countDistinct("word")).first()[0]
    known = lexicon.where(F.col("word").isNotNull() & F.col("tag").isNotNull()).select("word", "tag").distinct()
    rows = known.join(words, ["word", "tag"], "left").join(per_tag, "tag", "left")
    emit = F.log((F.coalesce("c", F.lit(0)) + 1) / (F.coalesce("ct", F.lit(0)) + F.lit(vocabulary)))
    listed = rows.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("tag", emit.alias("emit")))).alias("_cands"))
    return listed.select(F.col("word").alias("_word"), "_cands")


def tagger(table: dict[str, float]) -> Callable:
    """A function of three lists of a text to the best tag of each entry of the first, an ``array<string>``.

    ``kinds`` has the number of candidates of each token, 0 for an unknown one and -1 behind each sentence;
    ``tags`` and ``emits`` are the candidates of all its tokens. Ends of sentences have no tag, nor have the tokens of
    a sentence with no path, where only tags that the table lacks come before a token.
    """
    start, unseen, certain, only, none = START, [UNKNOWN], [0.0], [0], float("-inf")

    def move(memo: dict, before: str | None, tag: str) -> float | None:
        if (before, tag) not in memo:
            memo[before, tag] = table.get(f"{before} {tag}", table.get(before))
        return memo[before, tag]

    def best_tags(memo: dict, kinds: list, tags: list, emits: list) -> list:
        out: list = []
        at, ends, scores, steps = 0, [start], [0.0], []
        for kind in kinds:
            if kind < 0:
                top = max(range(len(scores)), key=scores.__getitem__)
                path: list = [None] * (len(steps) + 1)
                for i in range(len(steps) - 1, -1, -1) if scores[top] > none else ():
                    path[i], top = steps[i][0][top], steps[i][1][top]
                out += path
                ends, scores, steps = [start], [0.0], []
                continue
            if kind:
                options, emitted = tags[at : at + kind], emits[at : at + kind]
                at += kind
            else:
                options, emitted = unseen, certain
            if len(options) == 1 and len(scores) == 1:  # the most common step, without a choice
                pair = ends[0], options[0]
                moved = memo[pair] if pair in memo else move(memo, *pair)
                if moved is not None:
                    steps.append((options, only))
                    ends, scores = options, [scores[0] + moved + emitted[0]]
                    continue
            reached, came = [], []
            for tag, emit in zip(options, emitted):
                best, origin = none, None
                for i, score in enumerate(scores):
                    moved = move(memo, ends[i], tag) if score > none else None
                    if moved is not None and score + moved > best:
                        best, origin = score + moved, i
                reached.append(best + emit)
                came.append(origin)
            steps.append((options, came))
            ends, scores = options, reached
        return out

    @F.arrow_udf("array<string>")
    def tagged(kinds: pa.Array, tags: pa.Array, emits: pa.Array) -> pa.Array:
        memo: dict = {}
        kind = pa.list_(pa.string())
        texts = [
            pa.array([best_tags(memo, k.as_py(), t.as_py(), e.as_py())], kind) for k, t, e in zip(kinds, tags, emits)
        ]
        return pa.concat_arrays(texts) if texts else pa.array([], kind)

    return tagged


def tag_in_context(
    df: DataFrame,
    key: str,
    text: str,
    lexicon: DataFrame,
    tagged: DataFrame,
    lemmas: DataFrame | None = None,
    limit: int = INLINE_LIMIT,
) -> DataFrame:
    """``key`` and ``words``: the text's tokens in order as struct(token, tag[, v, n]) with the tag chosen in context.

    With ``lemmas`` (``word``, ``pos``, ``lemma``) each token also carries its verb (``v``) and noun (``n``) lemma.
    The word tables are joined first, so that each token is looked up once.
    """
    words, extra = candidates(lexicon, tagged), []
    if lemmas is not None:
        forms = lemmas.where("word IS NOT NULL").groupBy(F.col("word").alias("_word"))
        words = words.join(forms.agg(*(F.min(F.when(F.col("pos") == p, F.col("lemma"))).alias(p) for p in "vn")), "_word", "full_outer")
        extra = ["v", "n"]
    words = words.select("_word", F.struct(F.col("_cands").alias("cands"), *extra).alias("_value"))
    end = F.array(F.lit(None).cast("string"))
    tokens = F.flatten(F.transform(tx.sentences(F.col(text)), lambda s: F.concat(tx.blank_tokens(s), end)))
    # Exploding keeps the lists columns of their own, that each use below reads and none computes anew.
    found = looked_up(df, key, tokens, words, limit=limit)
    found = found.select(key, F.explode(F.array(F.struct("tokens", "found"))).alias("_l")).select(key, "_l.*")
    n_cands = F.zip_with(
        "tokens", "found", lambda t, f: F.when(t.isNull(), -1).otherwise(F.when(f["cands"].isNull(), 0).otherwise(F.size(f["cands"])))
    )
    listed = F.flatten(F.filter(F.transform("found", lambda f: f["cands"]), lambda c: c.isNotNull()))
    chosen = tagger(transitions(tagged))(n_cands, F.transform(listed, lambda c: c["tag"]), F.transform(listed, lambda c: c["emit"]))
    chosen = found.select(key, "tokens", "found", chosen.alias("_tags"))
    entries = F.arrays_zip(F.col("tokens").alias("token"), F.col("_tags").alias("tag"), F.col("found").alias("found"))
    kept = F.filter(entries, lambda w: w["token"].isNotNull())
    fields = lambda w: [w["token"].alias("token"), w["tag"].alias("tag"), *(w["found"][x].alias(x) for x in extra)]
    return chosen.select(key, F.transform(kept, lambda w: F.struct(*fields(w))).alias("words"))
