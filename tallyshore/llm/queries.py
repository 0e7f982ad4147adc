"""The operators bound to the check tables, one query each, and SQL where there is some."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshore.llm import (binary, collocations, embeddings, fingerprints, infill, licenses, lines, minhash, mixture,
                            quality, tokens, toxicity, urls)
from tallyshore.llm.common import Scratch, table

URL_RULES = (
    urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), minhash.Settings(shingle=2))


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).drop("url")


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.near_duplicates(table(spark, folder, "documents"), lines.ALL)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix(table(spark, folder, "documents"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


def op10_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = tokens.encode_documents(
        table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN, decode=True)
    return encoded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_orc_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{Scratch(spark, 'op11').folder}/tokens"
    ids = binary.encode_ordered(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    binary.write(ids, path)
    return binary.digests(binary.read(spark, path))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digests(infill.pieces(table(spark, folder, "documents")))


CATALOG = {f.__name__: f for f in (
    op1_minhash_dedup, op2_url_filters, op3_fingerprints, op4_line_dedup, op5_toxicity, op6_source_mix, op7_license_scan, op8_embedding_dedup, op9_quality,
    op10_bpe_round_trip, op11_orc_token_ids, op12_collocations, op13_fill_in_middle)}

ORACLES = {
    "op1_minhash_dedup": r"""
with recursive sets as (
  select doc_id, case when len(w) < 2 then w
           else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end s
  from (select doc_id, regexp_extract_all(translate(
          coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w
        from documents)),
cells as (select doc_id, len(s) n, unnest(s) shingle from sets),
links as materialized (
  select a.doc_id a, b.doc_id b from cells a join cells b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach as (
  select doc_id, doc_id root from sets
  union select l.b, root from reach r join links l on l.a = r.doc_id)
select doc_id, len(s)::bigint n_shingles, min(root) component_id, doc_id = min(root) kept
from sets join reach using (doc_id) group by doc_id, s""",
    "op2_url_filters": r"""
with raw as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end rest
  from pages),
cut as (select page_id, regexp_extract(coalesce(rest, ''), '^[^?#]*') rest from raw),
parts as (
  select page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
         substr(rest, length(split_part(rest, '/', 1)) + 1) path from cut),
rules(verdict, rhost, rpath) as (values
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
select page_id, host, path,
  (select rhost || rpath from rules where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
   order by length(rhost || rpath) desc, length(rhost) desc, verdict desc limit 1) as rule,
  coalesce((select verdict from rules where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
   order by length(rhost || rpath) desc, length(rhost) desc, verdict desc limit 1), 'allow') as verdict
from parts""",
    "op4_line_dedup": r"""
with recursive places as (
  select doc_id, unnest(range(len(l))) line_no, unnest(l) line
  from (select doc_id, string_split(text, chr(10)) l from documents)),
firsts as materialized (
  select line, length(line) size, length(line) // 3 third, translate(line, 'ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü', array_to_string(
           list_transform(list_concat(range(1, 9), range(14, 32)), lambda i: chr(i::int)), '')) flat, row_number() over (order by min(struct_pack(doc_id, line_no))) id,
         min(struct_pack(doc_id, line_no)) place
  from places where line <> '' group by line),
-- levenshtein counts bytes: in flat, each character of the tables is one;
-- two edits leave one of three parts as it is, so others need no distance
parts3 as (
  select *, left(line, third) one, substr(line, third + 1, third) two, substr(line, 2 * third + 1) three from firsts),
links as materialized (
  select a.id a, b.id b from parts3 a, (values (-2), (-1), (0), (1), (2)) gaps(gap), firsts b
  where b.size = a.size + gap and a.id <> b.id
    and case when contains(b.line, one) or contains(b.line, two) or contains(b.line, three)
             then levenshtein(a.flat, b.flat) <= 2 else false end),
reach as (
  select id, id root from firsts
  union select l.b, root from reach r join links l on l.a = r.id),
parts as (select id, min(root) root from reach group by id),
counts as (select a id, count(*) n from links group by a)
select p.doc_id, line_no, c.place.doc_id class_doc_id, c.place.line_no class_line_no, coalesce(n, 0)::bigint n_links,
  p.doc_id = c.place.doc_id and line_no = c.place.line_no kept
from places p join firsts f using (line) join parts on parts.id = f.id join firsts c on c.id = parts.root
left join counts on counts.id = f.id""",
    "op6_source_mix": r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size,
         md5('mix|' || coalesce(doc_id::varchar, '')) draw from documents),
sources as (
  select source, sum(size)::bigint source_size,
         ((row_number() over (order by source is null, encode(source)) - 1) % 3 + 1)::bigint weight
  from sized group by source),
levels as (
  select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over earlier, 0))::bigint::double
    / (sum(weight) over () - coalesce(sum(weight) over earlier, 0))::bigint as level
  from sources
  window earlier as (order by source_size * 6 // weight, source is null, encode(source)
                     rows between unbounded preceding and 1 preceding)),
aimed as (
  select source, source_size, least(max(level) over () * weight, (3 * source_size)::double) target from levels),
planned as (
  select *, round(target)::bigint words, coalesce(round(target)::bigint // nullif(source_size, 0), 0) whole from aimed),
placed as (
  select s.doc_id, s.source, s.size, p.source_size, p.target, p.whole, p.words - p.whole * p.source_size rest,
         sum(size) over (partition by s.source, draw) here,
         sum(size) over (partition by s.source order by draw range between unbounded preceding and current row) upto
  from sized s join planned p on s.source is not distinct from p.source)
select doc_id, source, size, source_size, target,
  (whole * size + case when upto <= rest then size
                       when upto - here < rest then size * (rest - (upto - here)) // here else 0 end)::bigint as taken
from placed""",
    "op7_license_scan": r"""
with texts as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t
  from documents),
listed as (
  select doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w, string_split(t, chr(10)) lines from texts),
places as (
  select doc_id, unnest(list_filter(range(1, len(w) + 1),
    lambda i: (w[i] = 'mit' or w[i] = 'apache') and w[i + 1] = 'license'
      or w[i] = 'general' and w[i + 1] = 'public' and w[i + 2] = 'license')) i, w
  from listed),
base as (
  select doc_id, count(*) n_base, min(i) - 1 first_word, max(i) - 1 last_word,
    list(distinct case w[i] when 'general' then 'gpl' else w[i] end) base
  from places group by doc_id),
templates as (select label, string_split(words, ' ') words from (values
  @templates@) t(label, words)),
blocks as (select doc_id, regexp_extract_all(unnest(lines), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') words from listed),
shares as (
  select doc_id, label, len(list_intersect(t.words, b.words)) / len(t.words) share from blocks b, templates t
  where list_has_any(t.words, b.words)),
more as (select doc_id, list(distinct label) more, max(share) share from shares where share >= 0.8 group by doc_id)
select l.doc_id, len(w)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word::bigint first_word,
  last_word::bigint last_word, coalesce(array_to_string(list_sort(base), ','), '') base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') labels,
  case when n_base > 0 then 1.0::double else coalesce(share, 0)::double end score
from listed l left join base b on l.doc_id = b.doc_id left join more m on l.doc_id = m.doc_id""".replace(
        "@templates@", ",\n  ".join(f"('{label}', '{words}')" for label, words in licenses.TEMPLATES)),
    "op8_embedding_dedup": r"""
with recursive vectors as (
  select vec_id, embedding::double[] e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (
  select a.vec_id a, b.vec_id b from vectors a, vectors b
  where a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (
  select vec_id, vec_id root from embeddings
  union select l.b, root from reach r join links l on l.a = r.vec_id),
parts as (select vec_id, min(root) component_id from reach group by vec_id),
counts as (select a vec_id, count(*) n from links group by a)
select vec_id, coalesce(n, 0)::bigint n_links, component_id, vec_id = component_id kept
from embeddings join parts using (vec_id) left join counts using (vec_id)""",
    "op12_collocations": r"""
with texts as (
  select coalesce(lang, 'und') lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
pieces as (
  select lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') w from texts),
counts as materialized (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') phrase, count(*) a
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i
        from pieces, (values (1), (2), (3), (4)) sizes(k) where len(w) >= k)
  group by all),
totals as (select lang, sum(a)::bigint n from counts where k = 1 group by lang),
candidates as (select lang, k, phrase, a, string_split(phrase, ' ') w from counts where k > 1 and a >= 30),
cuts as (
  select c.lang, c.phrase, c.a, j, x.a l, y.a r, (2000000::hugeint * c.a // (x.a + y.a))::bigint score
  from (select *, unnest(range(1, k)) j from candidates) c
  join counts x on x.lang = c.lang and x.phrase = array_to_string(w[1:j], ' ')
  join counts y on y.lang = c.lang and y.phrase = array_to_string(w[j + 1:c.k], ' ')),
weakest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (
  select lang, p phrase, max(a) longer
  from (select lang, a, unnest(flatten(list_transform(range(2, k), lambda s:
          list_transform(range(1, k - s + 2), lambda b: array_to_string(w[b:b + s - 1], ' '))))) p
        from candidates where k > 2)
  group by all),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) rank, phrase, a, l, r, score
  from weakest left join inside using (lang, phrase) where longer is null or 100 * longer < 80 * a)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000""",
    "op13_fill_in_middle": r"""
with hashed as (
  select doc_id, coalesce(text, '') t, length(coalesce(text, '')) n, sha256('1:' || doc_id) h from documents),
drawn as (
  select doc_id, t, n, ('0x' || substr(h, 1, 8))::bigint % (n + 1) one, ('0x' || substr(h, 9, 8))::bigint % (n + 1) two,
         ('0x' || substr(h, 17, 8))::bigint % 100 three, ('0x' || substr(h, 25, 8))::bigint % 100 four from hashed),
formed as (
  select *, least(one, two) a, greatest(one, two) b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or three >= 90 then 'plain'
              when four < 20 then 'spm' else 'psm' end form from drawn),
parted as (
  select *, substr(t, 1, a) prefix, substr(t, a + 1, b - a) middle, substr(t, b + 1) suffix from formed)
select doc_id, n, form, case when form <> 'plain' then a end prefix_chars,
  case when form <> 'plain' then b - a end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) output_sha256,
  sha256(t) restored_sha256
from parted""",
}
