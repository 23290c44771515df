"""The registered query of each operator, with the SQL that must give the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm import bpe, collocations, decontaminate, jaccard, licenses, lines, pii, tokens, topk, toxicity, urls, variants, warc
from wardmill.registry.base import CHECKS, QUERIES, query  # noqa: F401

LINE_KEY = (
    "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Any text serves as a key; a production run takes its own from a secret store.
PII_KEY = "wardmill"


@query("op1_pii_pseudonyms")
def op1_pii_pseudonyms(spark, d):
    found = pii.hide_private(read(spark, d, "documents"), PII_KEY)
    return found.select(
        F.col("id").alias("doc_id"), "text", F.size("found").cast("long").alias("n_private"),
        F.array_join("found.kind", ",").alias("kinds"),
    )


@query("op2_toxicity")
def op2_toxicity(spark, d):
    docs = read(spark, d, "documents")
    score = toxicity.toxicity(docs, read(spark, d, "labels"))
    found = docs.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= toxicity.REJECT).cast("int"))


@query("op3_decontaminate")
def op3_decontaminate(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    found = decontaminate.mark_passages(docs, read(spark, d, "benchmark"))
    return found.select("doc_id", F.inline("passages")).withColumnRenamed("item", "item_id")


@query("op4_line_dedup", f"""
with cut as (select doc_id, string_split(coalesce(text, ''), chr(10)) parts from documents),
line as (select doc_id, unnest(parts) line, generate_subscripts(parts, 1) place from cut),
keyed as (select *, {LINE_KEY} key from line),
hot as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10),
marked as (select k.*, h.key is not null gone from keyed k left join hot h on h.key = k.key)
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) kept_sha256
from marked group by doc_id""")
def op4_line_dedup(spark, d):
    found = lines.drop_shared_lines(read(spark, d, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_top_k", """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) w
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pair as (select q.vec_id query_id, c.vec_id vec_id,
    cast(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) as bigint) score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) "rank" from pair)
select query_id, "rank", vec_id, score from ranked where "rank" <= 10""")
def op5_top_k(spark, d):
    return topk.top_k(read(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op6_byte_bpe")
def op6_byte_bpe(spark, d):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = bpe.encode_documents(read(spark, d, "documents"), path, pattern, columns=("packed", "decoded"))
    return found.select(
        F.col("id").alias("doc_id"), F.shiftright(F.octet_length("packed"), 2).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query("op7_url_filter", r"""
with part as (select page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') path from pages),
rule(rule, verdict, rule_host, rule_path) as (values ('net/', 'block', 'net', '/'),
  ('example.net/en/', 'allow', 'example.net', '/en/'), ('example.com/de/', 'block', 'example.com', '/de/'),
  ('org/fr/', 'allow', 'org', '/fr/')),
fit as (select page_id, max_by(rule, length(rule)) rule, max_by(verdict, length(rule)) verdict
  from part join rule on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by page_id)
select part.page_id, host, path, rule, coalesce(verdict, 'allow') verdict
from part left join fit on fit.page_id = part.page_id""")
def op7_url_filter(spark, d):
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    found = urls.judge_urls(read(spark, d, "pages"), rules)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def license_sql() -> str:
    """The licence scan of documents in SQL, which weighs the terms of the templates' texts by itself."""
    texts = ", ".join(f"({n}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for n, (name, text) in enumerate(licenses.TEMPLATES))
    path = "concat_ws('/', source, lang, cast(doc_id as varchar))"
    return f"""
with template(number, template, body) as (values {texts}),
use as (select number, template, unnest(regexp_extract_all(lower(body), '{licenses.TERM}')) term from template),
used as (select number, template, term, count(*) n from use group by all),
low as (select doc_id, lower(coalesce(text, '')) body from documents),
seen as (select distinct doc_id, unnest(regexp_extract_all(body, '{licenses.TERM}')) term from low),
held as (select term, count(*) files from seen where term in (select term from used) group by term),
weight as (select term, ln((1 + (select count(*) from documents)) / (1 + coalesce(files, 0))) + 1 w
  from (select distinct term from used) left join held using (term)),
size as (select number, sqrt(sum(n * w * n * w)) size from used join weight using (term) group by number),
vector as (select number, template, term, n * w / size share from used join weight using (term) join size using (number)),
line as (select doc_id, unnest(string_split(body, chr(10))) line, generate_subscripts(string_split(body, chr(10)), 1) - 1 place from low),
class as (select *, regexp_matches(line, '[a-z0-9]') has, regexp_matches(line, '{licenses.COMMENT}') mark from line),
islands as (select *, place - row_number() over (partition by doc_id, has order by place) a,
  place - row_number() over (partition by doc_id, mark order by place) b from class),
block as (select doc_id, min(place) place, string_agg(line, chr(10) order by place) part from islands where has group by doc_id, a),
part as (select 'line' kind, doc_id, place, line part from line union all select 'file', doc_id, 0, body from low
  union all select 'block', doc_id, place, part from block
  union all select 'sentence', doc_id, place, unnest(string_split_regex(part, '{licenses.SENTENCE_END}')) from block
  union all select 'comment', doc_id, min(place), string_agg(line, chr(10) order by place) from islands where mark group by doc_id, b),
unit as (select row_number() over () nr, * from part),
word as (select nr, unnest(regexp_extract_all(part, '{licenses.TERM}')) term from unit),
counted as (select nr, term, count(*) n from word group by all),
valued as (select nr, term, n * coalesce(w, ln(1 + (select count(*) from documents)) + 1) v from counted left join weight using (term)),
norm as (select nr, sqrt(sum(v * v)) norm from valued group by nr),
dot as (select nr, number, template, sum(v * share) dot from valued join vector using (term) group by all),
scored as (select doc_id, kind, place, template, round(dot / norm, 6) score from dot join norm using (nr) join unit using (nr)),
own as (select doc_id, first(template order by template = 'Proprietary', score desc, place, template) template,
    first(score order by template = 'Proprietary', score desc, place, template) score,
    first(place order by template = 'Proprietary', score desc, place, template) place, bool_or(kind = 'file') is_file
  from scored where score >= {licenses.THRESHOLD} group by doc_id),
marked as (select doc_id, {path} path, template, score, place, regexp_extract({path}, '^(.*)/', 1) folder, is_file
  from documents left join own using (doc_id)),
given as (select folder up, arg_min(template, (-score, template)) template from marked where is_file group by folder),
nearest as (select m.folder, arg_max(up, length(up)) up, arg_max(g.template, length(up)) template
  from (select distinct folder from marked) m join given g on m.folder = up or up = '' or starts_with(m.folder, up || '/')
  group by m.folder)
select doc_id, path, coalesce(m.template, n.template) license, score, place,
  case when m.template is null then n.up end folder
from marked m left join nearest n using (folder)"""


@query("op8_license_scan", license_sql())
def op8_license_scan(spark, d):
    """Documents as files named by their id in the folders source/lang."""
    docs = read(spark, d, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    found = licenses.scan_licenses(docs, path)
    return found.select(F.col("id").alias("doc_id"), "path", "license", "score", F.col("place").cast("long").alias("place"), "folder")


@query("op9_token_counts")
def op9_token_counts(spark, d):
    found = tokens.token_counts(read(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


GRAMS = r"""
word as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
gram as (select distinct doc_id, unnest(case when len(w) >= 4
    then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g from word),
size as (select doc_id, count(*) n from gram group by doc_id)"""


@query("op10_jaccard_join", f"""
with recursive {GRAMS},
link as (select a.doc_id a, b.doc_id b from gram a join gram b on a.g = b.g and a.doc_id <> b.doc_id
  join size s on s.doc_id = a.doc_id join size t on t.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, s.n, t.n having 100 * count(*) >= 85 * (s.n + t.n - count(*))),
reach(doc_id, other) as (select doc_id, doc_id from documents
  union select r.doc_id, l.b from reach r join link l on l.a = r.other),
least as (select doc_id, min(other) component_id from reach group by doc_id)
select d.doc_id, coalesce(n, 0) n_shingles, component_id
from documents d left join size on size.doc_id = d.doc_id join least on least.doc_id = d.doc_id""")
def op10_jaccard_join(spark, d):
    found = jaccard.similar_documents(read(spark, d, "documents"), words=4, percent=85)
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


VARIANTS = """
with recursive crc as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t),
run as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{6,}')) run from documents),
keyed as (select run, doc_id || ':' || run k from run),
hexed as (select run, strlen(k) size, hex(encode(k)) x from keyed),
hashed as (select run, xor(list_reduce(list_prepend(4294967295, list_transform(range(size),
    lambda i: cast('0x' || substr(x, 2 * i + 1, 2) as bigint))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) h from hexed, crc),
word as (select case when h % 31 = 0 then substr(run, 1, cast(h % length(run) as bigint))
    || substr(run, cast(h % length(run) as bigint) + 2) else run end word from hashed),
v as materialized (select word, count(*) n from word where length(word) >= 7 group by word having count(*) >= 2),
place as (select word, n, unnest(range(length(word))) i from v),
cut as materialized (select word, n, i, substr(word, 1, i) || substr(word, i + 2) d from place),
shorter as (select distinct c.word, v.word near from cut c join v on v.word = c.d),
pair as (select a.word, b.word near from cut a join cut b on a.i = b.i and a.d = b.d and a.word <> b.word
  union select word, near from shorter union select near, word from shorter),
near as (select p.word, count(*) n_near, arg_min(near, (-v.n, near)) near, max(v.n) near_n
  from pair p join v on v.word = p.near group by p.word),
form as materialized (select v.word, v.n, coalesce(n_near, 0) n_near, case when near_n >= 10 * v.n then near end form,
    case when near_n >= 10 * v.n then near_n end form_n from v left join near on near.word = v.word),
way(word, stop, step) as (select word, word, 0 from form
  union all select way.word, form.form, step + 1 from way join form on form.word = way.stop where form.form is not null),
root as (select word, arg_max(stop, step) root from way group by word)
select word, form, root, n, n_near, form_n from form join root using (word)"""


def spoiled(doc_id, run):
    """The run without one letter where its checksum says so."""
    mark = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    place = (mark % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.char_length(run)))
    return F.when(mark % 31 == 0, cut).otherwise(run)


@query("op11_spelling_variants", VARIANTS)
def op11_spelling_variants(spark, d):
    found = variants.variants(read(spark, d, "documents"), change=spoiled)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_collocations", r"""
with piece as (select coalesce(lang, 'und') lang, row_number() over () id, unnest(regexp_split_to_array(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents),
word as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from piece),
total as (select lang, sum(len(w)) n from word group by lang),
gram as (select lang, w, m, unnest(range(1, len(w) - m + 2)) i from word, unnest(range(1, 6)) t(m) where len(w) >= m),
phrase as materialized (select lang, m, array_to_string(w[i:i + m - 1], ' ') phrase, any_value(w[i:i + m - 1]) words, count(*) a
  from gram group by all having count(*) >= 100),
cut as (select lang, phrase, words, m, a, unnest(range(1, m)) k from phrase where m > 1),
scored as (select c.lang, c.phrase, c.a, k, l.a l, r.a r, n,
    (1000::hugeint * c.a * n) // (l.a::hugeint * r.a) score
  from cut c join phrase l on l.lang = c.lang and l.m = k and l.phrase = array_to_string(c.words[1:k], ' ')
  join phrase r on r.lang = c.lang and r.m = c.m - k and r.phrase = array_to_string(c.words[k + 1:], ' ')
  join total on total.lang = c.lang),
best as (select *, row_number() over (partition by lang, phrase order by score, k) place from scored),
inner_ as (select lang, words, a, s, unnest(range(1, m - s + 2)) i from phrase, unnest(range(2, 5)) t(s) where s < m),
longer as (select lang, array_to_string(words[i:i + s - 1], ' ') phrase, max(a) a from inner_ group by all),
kept as (select b.* from best b left join longer g on g.lang = b.lang and g.phrase = b.phrase
  where place = 1 and (g.a is null or 100 * g.a < 100 * b.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) "rank" from kept)
select lang, "rank", phrase, a, l, r, cast(n as bigint) n, cast(score as bigint) score from ranked where "rank" <= 2000""")
def op12_collocations(spark, d):
    return collocations.collocations(read(spark, d, "documents"))


@query("op13_warc", """
with page as (select page_id, coalesce(html, '') html from pages),
record as (select page_id, strlen(html) payload_bytes, sha1(html) hex from page),
parts as (select *, list_transform(range(8), lambda i: cast('0x' || substr(hex, 5 * i + 1, 5) as int)) v from record),
named as (select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') payload_digest
  from parts),
first as (select *, max(page_id) over (partition by payload_digest) original from named)
select page_id, payload_bytes, payload_digest, case when page_id = original then 'response' else 'revisit' end record_type,
  case when page_id <> original then original end refers_to
from first""")
def op13_warc(spark, d):
    folder = warc.write_archives(read(spark, d, "pages"))
    found = warc.resolve_revisits(warc.read_archives(spark, folder))
    return found.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("original").cast("long").alias("refers_to"),
    )
