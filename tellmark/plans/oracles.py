"""The same results as plain SQL over the same tables, for checking."""
from __future__ import annotations

import re

from tellmark import lexicon as L
from tellmark.operators.evaluate import thresholds
from tellmark.plans.queries import HELD_OUT, MODELS, SCORE
from tellmark.sources.tables import REVIEWS_SQL


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pattern(p: str) -> str:
    """A shared pattern in RE2 terms: blanks and any-character spelled out."""
    return q(p.replace(r"[^\s", "[^" + L.WS[1:-1]).replace(r"\s", L.WS).replace(".*", r"[^\n]*"))


def words_in(lexicon: list[str]) -> str:
    return ", ".join(q(w) for w in lexicon)


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {q(f'^{L.WS}+|{L.WS}+$')}, '', 'g')"


def tokens(expr: str) -> str:
    return f"regexp_extract_all({expr}, {q(L.NON_WS + '+')})"


def lexicon_count(ws: str, lexicon: list[str]) -> str:
    return f"len(list_filter({ws}, lambda w: w in ({words_in(lexicon)})))"


def sentences(expr: str) -> str:
    cut = f"regexp_replace({expr}, {q(f'({L.SENTENCE_END}){L.WS}+')}, '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({cut}, chr(1)), lambda s: regexp_matches(s, {q(L.NON_WS)}))"


def std(n: str, total: str, squares: str) -> str:
    return f"sqrt(({n} * {squares} - {total} * {total})::double) / {n}"


REVIEWS = f"reviews as ({REVIEWS_SQL})"
WORD = q(L.WORD)
LOWER_WORD = q(L.LOWER_WORD)

STYLE = f"""
style_a as (
 select *, coalesce(text, '') as body, regexp_extract_all(lower(coalesce(text, '')), {LOWER_WORD}) as ws,
  list_transform({sentences("coalesce(text, '')")}, lambda s: len(regexp_extract_all(s, {WORD}))) as lens0
 from reviews),
style_b as (
 select *, greatest(len(ws), 1) as n, greatest(length(body), 1)::double as chars, {tokens('body')} as toks,
  case when len(lens0) > 0 then lens0 else [greatest(len(ws), 1)] end as lens from style_a),
style_c as (
 select *, list_sum(lens)::bigint as total,
  list_sum(list_transform(lens, lambda x: x * x))::bigint as squares from style_b),
style as (
 select review_id, category, _model, rating, label, text,
  len(list_distinct(ws))::double / n as type_token_ratio,
  total::double / len(lens) as mean_sentence_length,
  {std('len(lens)', 'total', 'squares')} as std_sentence_length,
  length(array_to_string(ws, ''))::double / n as mean_word_length,
  len(regexp_extract_all(body, {q('[' + ''.join(chr(92) + c for c in L.PUNCTUATION) + ']')}))::double / chars as punctuation_density,
  len(regexp_extract_all(body, '!'))::double / n as exclamation_ratio,
  len(regexp_extract_all(body, '[?]'))::double / n as question_ratio,
  len(list_filter(toks, lambda w: length(w) > 1 and upper(w) = w and lower(w) <> w))::double
   / greatest(len(toks), 1) as caps_ratio,
  {lexicon_count('ws', L.GENERIC_ADJECTIVES)}::double / n as generic_adjective_ratio,
  {lexicon_count('ws', L.HEDGES)}::double / n as hedging_ratio,
  {lexicon_count('ws', L.FIRST_PERSON)}::double / n as first_person_ratio,
  len(regexp_extract_all(body, {q(L.DIGIT)}))::double / chars as digit_ratio,
  n::double as word_count
 from style_c)"""


def hits(patterns: list[str]) -> str:
    return " + ".join(f"regexp_matches(low, {pattern(p)})::int" for p in patterns)


def rule_ctes(rating: str = "rating") -> str:
    return f"""
rule_a as (
 select *, {rating} as stars, coalesce(text, '') as body, lower(coalesce(text, '')) as low,
  regexp_extract_all(lower(coalesce(text, '')), {LOWER_WORD}) as ws,
  list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
   lambda p: len({tokens('p')})), lambda c: c > 0) as lines
 from reviews),
rule_b as (
 select *, greatest(len(ws), 1) as n,
  list_filter(list_transform(ws, lambda w, i: case when w in ({words_in(L.GENERIC_ADJECTIVES)}) then i else -1 end),
   lambda i: i >= 0) as marks,
  {lexicon_count('ws', L.GENERIC_ADJECTIVES + L.MORE_POSITIVE)} as pos, {lexicon_count('ws', L.NEGATIVE)} as neg,
  coalesce(list_sum(lines), 0)::bigint as total,
  coalesce(list_sum(list_transform(lines, lambda x: x * x)), 0)::bigint as squares
 from rule_a),
rules as (
 select review_id,
  ({hits(L.TEMPLATE_PHRASES)})::double as rule_template_hits,
  ({hits(L.PERSONA_PHRASES)})::double as rule_buyer_persona_phrases,
  regexp_matches(body, {pattern('(?i)^' + chr(92) + 's*(?:' + '|'.join(L.RATING_OPENERS) + ')')})::int::double as rule_starts_with_rating,
  len(regexp_extract_all(body, {pattern(L.MARKDOWN)}))::double as rule_markdown_artifacts,
  regexp_matches(body, {pattern('(?i)' + L.PROS_CONS)})::int::double as rule_pros_cons_structure,
  len(list_filter(range(2, len(marks) + 1), lambda j: marks[j] - marks[j - 1] <= {L.SUPERLATIVE_GAP}))::double / n as rule_superlative_density,
  coalesce((stars >= 4 and neg > pos and neg >= 2) or (stars <= 2 and pos > neg and pos >= 2), false)::int::double as rule_sentiment_rating_mismatch,
  len(regexp_extract_all(body, {q(L.EMOJI)}))::double as rule_emoji_count,
  case when len(lines) >= 2 then 1.0::double / (1.0::double + ({std('len(lines)', 'total', 'squares')}) / (total::double / len(lines)))
   else 0.0::double end as rule_avg_paragraph_perfection
 from rule_b)"""


RULES = rule_ctes()
SCORED = f"{REVIEWS}, {STYLE}, scored as (select *, {SCORE} as score from style where label is not null)"

REFUSED = "coalesce(regexp_matches(lower(text), " + q("|".join(L.REFUSALS)) + "), false)"
UNWRAPPED = strip(
    f"regexp_replace(regexp_replace(text, {q(f'^[*]+{L.WS}*')}, ''), {q(f'^#+{L.WS}*')}, '')"
)
WORDS_OK = f"coalesce(len({tokens('text')}) between {L.WORD_LIMITS[0]} and {L.WORD_LIMITS[1]}, false)"
FIRST_COPY = "row_number() over (partition by text order by review_id) = 1"

SPLIT_KEY = "md5(concat('42:', cast(review_id as varchar)))"


def split_of(source: str, keep: str = "*") -> str:
    return f"""
ranked as (select {keep}, row_number() over (order by {SPLIT_KEY}, review_id) - 1 as r,
  count(*) over () as n_all from {source}),
parts as (select *, case when r >= floor(0.9::double * n_all) then 'test'
  when r >= floor(0.8::double * n_all) then 'validation' else 'train' end as split from ranked)"""


def rates(tn="tn", fp="fp", fn="fn", tp="tp") -> str:
    def share(a: str, b: str) -> str:
        return f"round(coalesce(({a})::double / nullif(({b})::double, 0), 0.0), 6)"

    return f"""{tn}::bigint as tn, {fp}::bigint as fp, {fn}::bigint as fn, {tp}::bigint as tp,
 {share(f'{tp}+{tn}', f'{tn}+{fp}+{fn}+{tp}')} as accuracy, {share(tp, f'{tp}+{fp}')} as precision,
 {share(tp, f'{tp}+{fn}')} as recall, {share(f'2*{tp}', f'2*{tp}+{fp}+{fn}')} as f1, {share(fp, f'{fp}+{tn}')} as fpr"""


def cells(yes: str) -> str:
    return (
        f"count(*) filter (where not ({yes}) and label = 0) as tn, count(*) filter (where ({yes}) and label = 0) as fp, "
        f"count(*) filter (where not ({yes}) and label = 1) as fn, count(*) filter (where ({yes}) and label = 1) as tp"
    )


def auc(source: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    tail = f"group by {by}" if by else ""
    return f"""(select {keys} round(coalesce(sum(pos::double * (below + neg / 2.0)) / nullif(sum(pos)::double * sum(neg)::double, 0),
  'nan'::double), 6) as auc from (
  select {keys} score, pos, neg, coalesce(sum(neg) over ({part} order by score rows between unbounded preceding and 1 preceding), 0) as below
  from (select {keys} score, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg
   from {source} group by {keys} score)) {tail})"""


def sweep() -> str:
    grid = ", ".join(repr(t) + "::double" for t in thresholds(*L.SWEEP))
    return f"""grid as (select unnest([{grid}]) as thr),
counted as (select thr, {cells('score >= thr')} from scored, grid group by thr),
swept as (select round(thr, 6) as thr, {rates()} from counted)"""


BEST = "select * from swept order by (fpr <= 0.05) desc, f1 desc, thr limit 1"

MODEL_ROWS = " union all ".join(
    f"select label, {q(name)} as name, {thr}::double as thr, {score} as score from scored"
    for name, (score, thr) in MODELS.items()
)

BY_SPLIT = f"""{SCORED}, {split_of('scored')},
roles as (select label, score, case when _model = {q(HELD_OUT)} then 'heldout' else split end as split from parts),
counted as (select split, {cells('score > 0.6')} from roles group by split),
rated as (select split, {rates()}, 0.6::double as thr,
  coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0) as raw_f1 from counted),
gap as (select round(max(case when split = 'test' then raw_f1 end) - max(case when split = 'heldout' then raw_f1 end), 6) as f1_gap from rated),
evaluated as (select split, tn, fp, fn, tp, accuracy, precision, recall, f1, fpr, thr, auc, f1_gap
  from rated join {auc('roles', 'split')} using (split), gap)"""


def quota() -> str:
    return """have as (select _model, count(*) as collected from reviews group by _model),
quota as (select _model, collected, greatest(floor((select 2 * count(*) from reviews)::double / (select count(*) from have))
  - collected, 0)::bigint as needed from have)"""


def prompt_plan() -> str:
    def draw(slot: int) -> str:
        return f"('0x' || substr(h, {slot * 5 + 1}, 5))::bigint"

    def pick(slot: int, values: list) -> str:
        items = ", ".join(q(v) if isinstance(v, str) else str(v) for v in values)
        return f"([{items}])[{draw(slot)} % {len(values)} + 1]"

    stars = [s for s, weight in L.STAR_WEIGHTS.items() for _ in range(weight)]
    low, high = L.TEMPERATURE
    return f"""with {REVIEWS}, {quota()},
rows as (select _model, unnest(range(collected, collected + needed)) as i from quota where needed > 0),
hashed as (select *, md5(concat_ws(':', '42', _model, i::varchar)) as h from rows),
picked as (select _model, i::bigint as i, {pick(0, L.CATEGORIES)} as category, {pick(1, stars)}::int as rating,
  {pick(2, L.PERSONAS)} as persona, {pick(3, L.LENGTH_HINTS)} as length_hint, {pick(4, L.PROMPTS)} as template,
  round({low}::double + {high - low!r}::double * {draw(5)} / {float(16**5 - 1)!r}::double, 2) as _temp from hashed)
select _model, i, category, rating, persona, length_hint, _temp,
 replace(replace(replace(replace(template, '{{stars}}', rating::varchar), '{{category}}', category), '{{persona}}', persona),
  '{{length_hint}}', length_hint) as prompt from picked"""


def preamble(source: str, keys: str) -> str:
    steps = [f"p0 as (select {keys}, text from {source})"]
    for i, opening in enumerate(L.PREAMBLES):
        cut = "case " + " ".join(
            f"when instr(text, {q(end)}) between 2 and {L.PREAMBLE_REACH} then {strip(f'substr(text, instr(text, {q(end)}) + {len(end)})')}"
            for end in L.PREAMBLE_ENDS
        ) + " else text end"
        steps.append(
            f"p{i + 1} as (select {keys}, case when starts_with(lower(text), {q(opening)}) then {cut} else text end as text from p{i})"
        )
    return ", ".join(steps) + f" select {keys}, text from p{len(L.PREAMBLES)}"


REJECT = (
    f"case when text is null or length({strip('text')}) = 0 then 'empty' when length(text) > {L.REQUEST_CHARS} then 'too_long'"
)

FEATURES22 = L.TEXT_STYLE_FEATURES + L.TEXT_RULE_FEATURES

# --- language model -----------------------------------------------------------------------

NEIGHBOURS = f"""
said as (select review_id, {sentences("coalesce(text, '')")} as parts from reviews),
pieces as (select review_id, 0 as seq, lower(coalesce(text, '')) as piece from reviews
 union all
 select review_id, s.i as seq, lower(parts[s.i]) from said, unnest(range(1, len(parts) + 1)) as s(i)
 where len({tokens('parts[s.i]')}) >= 2),
piece_words as (select review_id, seq, regexp_extract_all(piece, {LOWER_WORD}) as ws from pieces),
pairs as (select review_id, seq, ws[p.i] as w1, ws[p.i + 1] as w2 from piece_words, unnest(range(1, len(ws))) as p(i)),
lm as (select w1, w2, count(*) as n from pairs where seq = 0 group by w1, w2)"""

PERPLEXITY = f"""{NEIGHBOURS},
starts as (select w1, sum(n) as n1 from lm group by w1),
costs as (select lm.w1, w2, -ln((n + 0.1::double) / (n1 + 0.1::double * (select count(distinct w2) + 1 from lm))) as cost
 from lm join starts on lm.w1 = starts.w1),
per_seq as (select review_id, seq, least(exp(avg(cost)), 1e6) as pp from pairs join costs using (w1, w2) group by review_id, seq),
per_review as (select review_id, max(case when seq = 0 then pp end) as perplexity,
  avg(case when seq > 0 then pp end) as m, stddev_pop(case when seq > 0 then pp end) as s from per_seq group by review_id),
spoken as (select review_id, count(*) filter (where seq > 0) > 0 as has from pieces group by review_id),
perplexed as (select review_id, perplexity, case when has then m else perplexity end as mean_sentence_perplexity,
  case when has then s else 0.0 end as burstiness from spoken left join per_review using (review_id))"""

# --- near-duplicates ------------------------------------------------------------------------

SHINGLES = f"""
doc_words as (select doc_id as review_id, regexp_extract_all(lower(coalesce(text, '')), {LOWER_WORD}) as ws from documents),
placed as (select review_id, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i, len(ws) as n from doc_words),
grams as (select review_id, i, n, w, lead(w, 1) over o as w2, lead(w, 2) over o as w3, lead(w, 3) over o as w4,
  lead(w, 4) over o as w5 from placed window o as (partition by review_id order by i)),
shingles as (
 select distinct review_id, concat_ws(' ', w, w2, w3, w4, w5) as shingle from grams where n >= 5 and w5 is not null
 union all
 select review_id, array_to_string(ws, ' ') as shingle from doc_words where len(ws) < 5)"""

NEAR = f"""with {SHINGLES},
sized as (select review_id, count(*) as n from shingles group by review_id),
common as (select a.review_id as a, b.review_id as b, count(*) as c from shingles a join shingles b
 on a.shingle = b.shingle and a.review_id <> b.review_id group by 1, 2),
best as (select a as review_id, max(c::double / (x.n + y.n - c)) as j from common
 join sized x on a = x.review_id join sized y on b = y.review_id where c::double / (x.n + y.n - c) >= 0.6 group by 1)
select d.doc_id as review_id, (j is not null)::int::double as rule_near_duplicate, round(coalesce(j, 0.0), 6) as rule_max_jaccard
from documents d left join best on d.doc_id = best.review_id"""

# --- reasons -----------------------------------------------------------------------------------

def wording(template: str, value: str, norm: float) -> str:
    parts = []
    for text, name, spec in re.findall(r"([^{]*)(?:\{(v|n):([^}]*)\})?", template):
        if text:
            parts.append(q(text))
        if name:
            number = value if name == "v" else f"{norm}::double"
            shown = f"printf('%.0f%%', 100 * {number})" if spec == ".0%" else f"printf('%{spec}', {number})"
            parts.append(shown)
    return " || ".join(parts)


def reason_items() -> str:
    items = []
    for i, f in enumerate(FEATURES22):
        weight = f"({f} / ({f} + 1.0::double) - 0.02::double)"
        if f in L.RULE_REASONS:
            least, template = L.RULE_REASONS[f]
            fires, category, text = f"{f} >= {least}", "structural", wording(template, f, 0.0)
        else:
            sign, template = L.STYLE_REASONS[f]
            norm = L.HUMAN_NORMS.get(f)
            if norm is None:
                fires = "true"
            else:
                fires = f"not ({f} >= {norm}::double * 0.9::double)" if sign < 0 else f"not ({f} <= {norm}::double * 1.1::double)"
            category, text = "linguistic", wording(template, f, norm or 0.0)
        items.append(
            f"select review_id, verdict, {i} as i, {weight} as weight, '{category}' as category, {text} as message "
            f"from wide where verdict <> 'likely_human' and {weight} > 0 and ({fires})"
        )
    return " union all ".join(items)


VERDICT = f"case when {SCORE} >= 0.7 then 'likely_ai' when {SCORE} >= {L.UNCERTAIN_FROM} then 'uncertain' else 'likely_human' end"

REASONS = f"""with {REVIEWS}, {STYLE}, {RULES},
wide as (select style.*, rules.* exclude (review_id), {VERDICT} as verdict from style join rules using (review_id)),
candidates as ({reason_items()}),
top as (select * from candidates qualify row_number() over (partition by review_id order by weight desc, i) <= {L.TOP_REASONS}),
found as (select review_id, string_agg(category || '|' || message, chr(10) order by weight desc, i) as reasons,
  list(message order by weight desc, i) as messages, sum(weight) as weight from top group by review_id),
reasoned as (select w.review_id, w.verdict, {SCORE} as prob,
  case when messages is null and verdict = 'likely_ai' then [{q(L.COMBINED_REASON)}] else coalesce(messages, []) end as messages,
  case when messages is null and verdict = 'likely_ai' then {q('statistical|' + L.COMBINED_REASON)} else coalesce(reasons, '') end as reasons,
  case when messages is null and verdict = 'likely_ai' then {SCORE} else coalesce(weight, 0.0) end as weight
 from wide w left join found using (review_id))"""

OFFSETS = f"""
cut as (select review_id, coalesce(text, '') as body from reviews),
listed as (select review_id, regexp_extract_all(body, {WORD}) as ws, regexp_split_to_array(body, {WORD}) as gaps from cut),
steps as (select review_id, unnest(range(1, len(ws) + 1)) as pos, unnest(ws) as text, unnest(gaps[1:len(ws)]) as gap from listed),
offsets as (select review_id, text, lower(text) as token,
  sum(length(gap) + length(text)) over (partition by review_id order by pos rows between unbounded preceding and current row) as "end"
 from steps),
spans as (select review_id, ("end" - length(text))::bigint as start, "end"::bigint as "end", text, token from offsets)"""

def _discounted(order: str, counts: str, context: str) -> str:
    """CTEs with the discounts of an order, its contexts and its shares."""
    step = lambda k: f"least(greatest(coalesce({k} - {k + 1} * y * n{k + 1} / nullif(n{k}, 0), y), 0.1), {k})"
    inside = f"using ({context})" if context else "on true"
    return f"""
n{order} as (select {", ".join(f"count(*) filter (where c = {k})::double as n{k}" for k in (1, 2, 3, 4))} from {counts}),
y{order} as (select *, coalesce(n1 / nullif(n1 + 2 * n2, 0), 0.5) as y from n{order}),
d{order} as (select t.*, case c when 1 then {step(1)} when 2 then {step(2)} else {step(3)} end::double as d from {counts} t, y{order}),
b{order} as (select {context + "," if context else ""} sum(c)::double as total, sum(d) / sum(c) as g, count(*) as known from d{order} {"group by " + context if context else ""}),
p{order} as (select d{order}.* exclude (c, d), (c - d) / total as p from d{order} join b{order} {inside})"""


def _placed(table: str, key: str) -> str:
    seq = "['<s>', '<s>'] || ws || ['</s>']"
    return f"""(select {key}, seq[i] as w1, seq[i + 1] as w2, seq[i + 2] as w3 from (select {key}, {seq} as seq, unnest(range(1, len(ws) + 2)) as i
 from (select {key}, regexp_extract_all(lower(coalesce(text, '')), '[a-z'']+') as ws from {table}) where len(ws) > 0))"""


KNESER_NEY = f"""with c3 as (select w1, w2, w3, count(*) as c from {_placed('documents', 'doc_id')} group by all),
c2 as (select w2, w3, count(*) as c from c3 group by all), c1 as (select w3, count(*) as c from c2 group by all),
{_discounted('3', 'c3', 'w1, w2')}, {_discounted('2', 'c2', 'w2')}, {_discounted('1', 'c1', '')},
met as (select item_id, w1, w2, w3, count(*) as n from {_placed('benchmark', 'item_id')} group by all),
asked as (select met.*, ln(coalesce(p3.p, 0) + coalesce(b3.g, 1) * (coalesce(p2.p, 0) + coalesce(b2.g, 1) * (coalesce(p1.p, 0) + b1.g / (b1.known + 1)))) as ln
 from met left join p3 using (w1, w2, w3) left join b3 using (w1, w2) left join p2 using (w2, w3) left join b2 using (w2) left join p1 using (w3), b1)
select item_id, sum(n)::bigint as predicted, round(exp(-sum(n * ln) / sum(n)), 4) as perplexity from asked group by item_id"""


ORACLES = {
    "read_reviews": f"with {REVIEWS} select review_id, category, rating, text, label from reviews",
    "csv_round_trip": f"with {REVIEWS} select review_id, category, rating, text, label, _model, null::double as _temp from reviews",
    "load_splits": f"""with {REVIEWS}, pool as (select * from reviews where _model <> {q(HELD_OUT)}), {split_of('pool')}
select review_id, label, split from parts union all
select review_id, label, 'heldout' as split from reviews where _model = {q(HELD_OUT)}""",
    "conform": f"with {REVIEWS} select review_id, text, label from reviews",
    "feature_columns": f"with {REVIEWS}, {STYLE} select review_id, {', '.join(L.TEXT_STYLE_FEATURES)} from style",
    "append_new": "select doc_id as review_id, 1::bigint as copies from documents",
    "score_with_cache": f"""with {REVIEWS} select review_id, '{{"words":' || len({tokens('text')}) || '}}' as payload from reviews""",
    "metadata_round_trip": f"with {SCORED}, {sweep()} select thr as best_threshold, {len(L.FEATURES)}::bigint as n_features, f1 from ({BEST})",
    "filter_refusals": f"with {REVIEWS} select review_id, text from reviews where not {REFUSED}",
    "strip_wrappers": f"with {REVIEWS} select review_id, {UNWRAPPED} as text from reviews",
    "dedupe_text": f"with {REVIEWS}, s as (select review_id, {UNWRAPPED} as text from reviews) select * from s qualify {FIRST_COPY}",
    "filter_word_count": f"with {REVIEWS} select review_id from reviews where {WORDS_OK}",
    "clean_reviews": f"""with {REVIEWS}, s as (select * replace ({UNWRAPPED} as text) from reviews where not {REFUSED}),
d as (select * from s qualify {FIRST_COPY}) select review_id, category, rating, text, label from d where {WORDS_OK}""",
    "clean_report": f"""with {REVIEWS}, s as (select * replace ({UNWRAPPED} as text), {REFUSED} as refused from reviews),
d as (select * from s where not refused qualify {FIRST_COPY})
select (select count(*) from s) as raw, (select count(*) from s where refused) as refusals,
 (select count(*) from s where not refused) - (select count(*) from d) as duplicates,
 (select count(*) from d where {WORDS_OK}) as kept""",
    "holdout_generator": f"with {REVIEWS} select review_id, case when _model = {q(HELD_OUT)} then 'heldout' else 'pool' end as role from reviews",
    "combine": f"""with {REVIEWS} select review_id, category, rating, text, label from reviews union all
select -1 - (conv_id * 1048576 + turn), role, null, text, 1 from conversations""",
    "split_reviews": f"with {REVIEWS}, {split_of('reviews')} select review_id, split from parts",
    "split_sizes": f"with {REVIEWS}, {split_of('reviews')} select split, count(*) as n from parts group by split",
    "screen_roles": f"""with {REVIEWS}, pool as (select review_id from reviews where label is not null and _model is distinct from {q(HELD_OUT)}),
r as (select review_id, row_number() over (order by {SPLIT_KEY}, review_id) - 1 as r, count(*) over () as n from pool)
select review_id, case when r < floor(0.6::double * n) then 'train' when r < floor(0.8::double * n) then 'validation'
 when md5(concat('43:', review_id::varchar)) < '8' then 'tune' else 'test' end as split from r
union all select review_id, 'heldout' from reviews where label is not null and _model = {q(HELD_OUT)}""",
    "detect_facts": "select doc_id as review_id, true as follows, true as verdict_fits from documents",
    "threshold_facts": f"select true as same_threshold, true as same_f1, true as has_auc, {len(L.FEATURES)}::bigint as medians",
    "epoch_facts": "select 4::bigint as epochs, true as kept_is_best, true as same_f1",
    "live_facts": "select doc_id as review_id, true as same, doc_id % 2 + 1 as model_version from documents",
    "model_round_trip_facts": "select doc_id as review_id, true as same from documents",
    "feature_importance_facts": f"select {len(L.FEATURES)}::bigint as features, 1.0::double as total, true as none_negative",
    "feature_contributions_facts": "select doc_id as review_id, true as adds_up from documents",
    "generation_quota": f"with {REVIEWS}, {quota()} select * from quota",
    "prompt_plan": prompt_plan(),
    "accept_generated": f"""with s as (select conv_id, turn, {strip(f"regexp_replace({strip('text')}, '^[\"]+|[\"]+$', '', 'g')")} as text from conversations)
select conv_id, turn, text, 1 as label from s where len({tokens('text')}) >= {L.WORD_LIMITS[0]}""",
    "strip_preamble": f"with {REVIEWS}, {preamble('reviews', 'review_id')}",
    "strip_preamble_turns": f"with {preamble('conversations', 'conv_id, turn')}",
    "validate_reviews": f"with {REVIEWS} select review_id, {REJECT} when length({strip('text')}) < {L.SHORTEST_REQUEST} then 'too_short' end as reject_reason from reviews",
    "profile_shape": "select count(*) as n_rows, 5::bigint as n_columns from documents",
    "value_counts": f"with {REVIEWS} select category as value, count(*) as n from reviews where category is not null group by category",
    "value_shares": f"with {REVIEWS} select label as value, count(*)::double / (select count(*) from reviews where label is not null) as share from reviews where label is not null group by label",
    "describe_words": f"""with {REVIEWS}, w as (select len({tokens('text')}) as wc from reviews where text is not null)
select count(*) as count, round(avg(wc), 6) as mean, round(stddev_samp(wc), 6) as std, min(wc)::bigint as min,
 quantile_cont(wc, 0.25)::double as p25, quantile_cont(wc, 0.5)::double as p50, quantile_cont(wc, 0.75)::double as p75, max(wc)::bigint as max from w""",
    "mean_chars_by_label": f"with {REVIEWS} select label, round(avg(length(text)), 6) as mean_chars from reviews where label is not null group by label",
    "feature_means_by_label": f"with {REVIEWS}, {STYLE}, {RULES}, wide as (select style.*, rules.* exclude (review_id) from style join rules using (review_id)) "
    + " union all ".join(
        f"select {q(f)} as feature, round(avg({f}) filter (where label = 0), 6) as label_0, round(avg({f}) filter (where label = 1), 6) as label_1, "
        f"round(avg({f}) filter (where label = 1) - avg({f}) filter (where label = 0), 6) as diff from wide" for f in FEATURES22
    ),
    "impute_median": f"""with {REVIEWS}, {STYLE}, m as (select median(mean_word_length) filter (where label is not null) as mid from style)
select review_id, case when label is not null then mean_word_length else mid end as mean_word_length, punctuation_density from style, m""",
    "fit_medians": f"with {REVIEWS}, {STYLE} " + " union all ".join(f"select {q(f)} as feature, median({f}) as median from style" for f in L.TEXT_STYLE_FEATURES),
    "style_features": f"with {REVIEWS}, {STYLE} select review_id, {', '.join(L.TEXT_STYLE_FEATURES)} from style",
    "rule_features": f"with {REVIEWS}, {RULES} select * from rules",
    "fit_bigram_lm": f"with {REVIEWS}, {NEIGHBOURS} select w1, w2, n from lm",
    "perplexity_features": f"""with {REVIEWS}, {PERPLEXITY} select review_id, {', '.join(f'round({f}, 4) as {f}' for f in L.PERPLEXITY_FEATURES)} from perplexed""",
    "kneser_ney_perplexity": KNESER_NEY,
    "human_norms": f"""with {REVIEWS}, {STYLE}, {PERPLEXITY} select {', '.join(f'round(avg({f}), 4) as {f}' for f in L.HUMAN_NORMS)}
from style join perplexed using (review_id) where label = 0""",
    "shingles": f"with {SHINGLES} select review_id, count(*) as n, min(shingle) as first, max(shingle) as last from shingles group by review_id",
    "near_duplicates_exact": NEAR,
    "lsh_recall_facts": f"select sum(rule_near_duplicate)::bigint as near, true as recall_reached, true as few_wrong from ({NEAR}) where review_id % 50 = 0",
    "jaccard_scores": f"""with {SHINGLES}, firsts as (select source, min(doc_id) as other from documents group by source),
asked as (select doc_id as id, other from documents join firsts using (source)),
sized as (select review_id, count(*) as n from shingles group by review_id),
common as (select id, other, count(*) as c from asked join shingles a on a.review_id = id join shingles b on b.review_id = other and a.shingle = b.shingle group by id, other)
select id, other, round(coalesce(c, 0)::double / (x.n + y.n - coalesce(c, 0)), 6) as jaccard from asked left join common using (id, other)
 join sized x on x.review_id = id join sized y on y.review_id = other""",
    "attributions_facts": f"""with {REVIEWS}, {STYLE} select review_id, len(regexp_extract_all(reviews.text, '[A-Za-z'']+'))::bigint as words, true as adds_up
from style join reviews using (review_id) where {SCORE} >= {L.HIGHLIGHT_FROM} and reviews.text is not null""",
    "cached_spans_facts": f"""with {REVIEWS}, {STYLE} select review_id, true as same, true as nothing_found_twice
from style join reviews using (review_id) where {SCORE} >= {L.HIGHLIGHT_FROM}""",
    "linear_attributions": """with w as (select item_id as review_id, unnest(regexp_extract_all(text, '[A-Za-z'']+')) as word from benchmark)
select review_id, count(*) as words, 0::bigint as off, round(sum(length(word) - 4) / 100.0::double, 6) as total, sum(length(word))::bigint as letters from w group by review_id""",
    "score_with_model": f"with {REVIEWS} select review_id, length(text) / (length(text) + 1000.0::double) as prob from reviews",
    "assemble_features": f"with {REVIEWS}, {STYLE}, {RULES} select review_id, 22::bigint as n, {FEATURES22[0]} as first, {FEATURES22[-1]} as last from style join rules using (review_id)",
    "classify_reviews": f"""with {REVIEWS}, {STYLE}, c as (select review_id, {SCORE} as p, {REJECT} end as reject_reason from style)
select review_id, reject_reason, case when reject_reason is null then case when p > 0.5 then 'ai' else 'human' end end as classification,
 case when reject_reason is null then round(case when p > 0.5 then p else 1 - p end, 4) end as confidence,
 case when reject_reason is null then case when p > 0.5 then {q(L.DISPLAY_LABELS['ai'])} else {q(L.DISPLAY_LABELS['human'])} end end as display_label from c""",
    "confusion": f"with {SCORED} select {cells('score >= 0.5')} from scored",
    "metrics_at": f"with {SCORED}, c as (select {cells('score >= 0.6')} from scored) select {rates()}, 0.6::double as thr from c",
    "roc_auc": f"with {SCORED} select auc from {auc('scored')}",
    "threshold_sweep": f"with {SCORED}, {sweep()} select * from swept",
    "best_threshold": f"with {SCORED}, {sweep()} {BEST}",
    "compare_models": f"""with {SCORED}, stacked as ({MODEL_ROWS}), c as (select name, thr, {cells('score >= thr')} from stacked group by name, thr)
select name, thr, {rates()}, auc from c join {auc('stacked', 'name')} using (name)""",
    "evaluate_splits": f"with {BY_SPLIT} select * from evaluated",
    "quality_gates": f"""with {BY_SPLIT} select split, case when fpr < {L.MAX_FPR} then 'ok' when fpr > {L.ALARM_FPR} then 'too_high' else 'watch' end as fpr_gate,
 case when f1_gap is null then 'unknown' when f1_gap <= {L.MAX_F1_GAP} then 'ok' else 'memorised' end as gap_gate from evaluated""",
    "verdicts": f"with {REVIEWS}, {STYLE} select review_id, {VERDICT} as verdict from style",
    "rule_callouts": f"with {REVIEWS}, {RULES} select review_id, concat_ws(chr(10), "
    + ", ".join(f"case when {f} >= {least} then {wording(t, f, 0.0)} end" for f, (least, t) in L.RULE_REASONS.items() if f != "rule_near_duplicate")
    + ") as callouts from rules",
    "rank_reasons": f"{REASONS} select review_id, verdict, reasons, round(weight, 6) as weight from reasoned",
    "plain_summary": f"""{REASONS} select review_id,
 case when verdict = 'likely_human' then {q(L.HUMAN_SUMMARY)} when len(messages) = 0 and verdict = 'uncertain' then {q(L.MIXED_SUMMARY)}
  when len(messages) = 0 then {q(L.PATTERN_SUMMARY)} else messages[1] end as summary,
 case when prob >= {L.VERY_LIKELY_FROM} then 'very likely' when prob >= {L.HIGHLIGHT_FROM} then 'likely' else 'possibly' end as confidence_word,
 array_to_string(list_transform(messages, lambda m: '- ' || m), chr(10)) as reason_list from reasoned""",
    "token_offsets": f"""with {REVIEWS}, {OFFSETS} select review_id, count(*) as n, sum(start)::bigint as starts, sum("end")::bigint as ends, max(token) as last from spans group by review_id""",
    "top_spans": f"""with {REVIEWS}, {OFFSETS}, s as (select review_id, start, "end", text, (length(text) - 3) / 10.0::double as score from spans
 where length(text) > 3 and len(regexp_extract_all(text, '[A-Za-z]')) >= greatest(3, floor(0.6 * length(text))))
select review_id, row_number() over (partition by review_id order by score desc, start) as rank, start, "end", text, score from s
qualify rank <= {L.TOP_SPANS}""",
    "score_stream": f"""with reviews as (select doc_id as review_id, text, null::double as rating, null as category, null as _model, null as label from documents), {STYLE}, {rule_ctes()},
c as (select review_id, {SCORE} as p, {REJECT} end as reject_reason from style)
select rules.*, reject_reason, case when reject_reason is null then case when p > 0.5 then 'ai' else 'human' end end as classification,
 case when reject_reason is null then round(case when p > 0.5 then p else 1 - p end, 4) end as confidence from rules join c using (review_id)""",
    "dedupe_stream": "select sha256(text) as text_hash, count(*) as copies from documents group by 1",
    "counted_copies": """with t as (select event_id as doc_id, min(ts)::timestamp as ts from events group by 1),
d as (select doc_id, text, coalesce(ts, timestamp '1970-01-01') as ts from documents left join t using (doc_id) where text is not null)
select sha256(text) as text_hash, doc_id as review_id, count(*) over (partition by text) as copies from d qualify row_number() over (partition by text order by ts, doc_id) = 1""",
    "score_stream_cached": f"""select doc_id as review_id, '{{"words":' || len({tokens('text')}) || '}}' as payload from documents""",
}
