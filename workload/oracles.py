"""The same results in plain SQL, for DuckDB over the driver tables."""

from __future__ import annotations

from commitloom import fixed_values as fv
from workload.queries import BOS, CAP, EOS, MAX_DIFF, MAX_STYLE, PAD, ROW_LENGTH

ORACLES: dict[str, str] = {}


def _literal(text: str) -> str:
    """SQL string; control characters are spelled out."""
    parts, plain = [], ""
    for ch in text:
        if ord(ch) < 32 or 0x7F <= ord(ch) <= 0xA0:
            parts += [f"'{plain}'"] if plain else []
            parts.append(f"chr({ord(ch)})")
            plain = ""
        else:
            plain += "''" if ch == "'" else ch
    parts += [f"'{plain}'"] if plain or not parts else []
    return "(" + " || ".join(parts) + ")"


_WS = _literal("".join(map(chr, fv.WHITESPACE_CODE_POINTS)))
_MARKER = _literal(fv.TRUNCATION_MARKER)


def _strip(text: str) -> str:
    return f"trim({text}, {_WS})"


def _line(text: str) -> str:
    return f"split_part({text}, chr(10), 1)"


def _cut(text: str, size: int) -> str:
    return f"case when length({text}) > {size} then substr({text}, 1, {size}) || {_MARKER} else {text} end"


def _clean(message: str) -> str:
    out = _strip(_line(_strip(message)))
    for pattern in ("(?i)" + fv.ISSUE_PHRASE, fv.ISSUE_IN_PARENTHESES, fv.ISSUE_GLUED):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    out = rf"regexp_replace({out}, '\s+', ' ', 'g')"
    return f"trim({_strip(out)}, '{fv.SUBJECT_PUNCTUATION}')"


_KEPT = "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in fv.KEPT_RANGES)


def _unlisted(text: str) -> str:
    return f"regexp_replace({text}, '[^{_KEPT}]', '', 'g')"


def _newlines(text: str) -> str:
    return f"replace(replace({text}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def _squeeze(text: str) -> str:
    return _strip(f"regexp_replace({text}, ' {{2,}}', ' ', 'g')")


def _normalized(text: str) -> str:
    chain = _squeeze(_newlines(_unlisted(f"nfc_normalize({text})")))
    return f"case when length({_strip(text)}) = 0 then {text} else {chain} end"


def _noise(message: str) -> str:
    stripped = _strip(message)
    return (
        rf"(regexp_matches({stripped}, '^[Mm]erge\s') or regexp_matches({stripped}, '^[Rr]evert\s')"
        f" or starts_with({stripped}, 'squash!') or starts_with({stripped}, 'fixup!'))"
    )


_BOT = r"regexp_matches(author_name, '(?i)\b(?:bot|robot)\b|\[bot\]')"


def _diffs(size: int) -> str:
    return f"""
select commit_key, {_cut("whole", size)} as change, files
from (select commit_key, string_agg(patch_text, '' order by patch_idx) as whole,
             list_sort(list_distinct(flatten(list([new_path, old_path])))) as files
      from running where before <= {size} group by commit_key)"""


def _styles(size: int) -> str:
    return f"""
select repo, {_cut("content", size)} as code_style
from (select repo, {_newlines("content")} as content, row_number() over (partition by repo order by
        case path when 'CONTRIBUTING.md' then 1 when '.github/CONTRIBUTING.md' then 2 else 3 end) as rn
      from repo_files where path in ('CONTRIBUTING.md', '.github/CONTRIBUTING.md', 'STYLEGUIDE.md'))
where rn = 1"""


# --- the history tables --------------------------------------------------------

_VIEWS = {
    "commits": """
select o_orderkey as commit_key, sha1(concat('', o_orderkey)) as commit_id,
       concat('own', o_custkey % 7, '/repo', o_custkey) as repo, o_orderdate as committed_at,
       case when o_orderpriority = '1-URGENT' then 2 else 1 end as n_parents,
       case when o_orderstatus = 'P' then 'deploy[bot]' else concat('dev', o_custkey % 97) end as author_name,
       concat(case o_orderkey % 10 when 0 then 'Merge ' when 1 then 'Revert ' when 2 then 'fixup! '
              when 3 then 'Fixes #12 ' else '' end, text) as message
from orders cross join (select count(*) as nd from documents) k join documents on doc_id = o_orderkey % nd""",
    "patches": """
select l_orderkey as commit_key,
       row_number() over (partition by l_orderkey
         order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as patch_idx,
       concat('src/', p_brand, '/', p_partkey % 7, '.py') as new_path,
       concat('src/', p_brand, '/', p_partkey % 5, '.py') as old_path,
       concat('diff ', l_partkey, ' ', l_returnflag, '|', repeat('+', cast(l_quantity as int))) as patch_text
from lineitem join part on p_partkey = l_partkey""",
    "styled": """
select c_custkey, concat('own', c_custkey % 7, '/repo', c_custkey) as repo, text
from customer cross join (select count(*) as nd from documents) k join documents on doc_id = c_custkey % nd
where c_mktsegment <> 'FURNITURE'""",
    "repo_files": """
select repo, case c_custkey % 4 when 0 then 'STYLEGUIDE.md' when 1 then 'CONTRIBUTING.md'
             else '.github/CONTRIBUTING.md' end as path, text as content from styled
union all
select repo, case c_custkey % 4 when 2 then 'CONTRIBUTING.md' when 3 then 'STYLEGUIDE.md'
             else 'README.md' end, 'second' || chr(13) || chr(10) || text from styled""",
    "repo_catalog": """
select distinct concat('own', page_id % 23, '/', lang, '-', source) as full_name, lang as language,
       n_chars as stars, doc_id % 5 = 0 as archived
from documents cross join (select count(*) as np from pages) k join pages on page_id = doc_id % np""",
    "repositories": "select concat('own', c_custkey % 7, '/repo', c_custkey) as repo from customer",
    "licences": """
select concat('own', c_custkey % 7, '/repo', c_custkey) as repo,
       case when source = 'src1' then 'No License'
            when source in ('src2', 'src3') then 'Detection Failed: JSONDecodeError'
            when lang in ('en', 'fr', 'de') then source else 'Unknown' end as license
from customer cross join (select count(*) as nd from documents) k join documents on doc_id = c_custkey % nd""",
    "sources": """
select concat('own', c_custkey % 7, '/repo', c_custkey) as repo,
       case when starts_with(url, 'https:') then url else url || '/mirror' end as repo_source
from customer cross join (select count(*) as np from pages) k join pages on page_id = c_custkey % np""",
    "parented": """
select repo, commit_id, case when o_totalprice > 480000 then 'gone-' || commit_id else previous end as parent
from (select concat('own', o_custkey % 7, '/repo', o_custkey) as repo, sha1(concat('', o_orderkey)) as commit_id,
             o_totalprice, lag(sha1(concat('', o_orderkey)))
             over (partition by o_custkey order by o_orderdate, o_orderkey) as previous from orders)""",
    "branching": """
select repo, commit_id, committed_at, position, list_filter([case when o_totalprice > 480000 then 'gone-' || commit_id
         else previous end, case when position % 4 = 0 then earlier end], lambda p: p is not null) as parents
from (select concat('own', o_custkey % 7, '/repo', o_custkey) as repo, sha1(concat('', o_orderkey)) as commit_id, o_totalprice,
             o_orderdate + case when o_orderkey % 6 = 0 then interval 400 days else interval 0 days end as committed_at,
             row_number() over w as position, lag(sha1(concat('', o_orderkey)), 1) over w as previous,
             lag(sha1(concat('', o_orderkey)), 3) over w as earlier
      from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey))""",
    "refs": """
select b.repo, b.commit_id from branching b join (select repo, max(position) as newest from branching group by repo) n
  on b.repo = n.repo and b.position = case when right(b.repo, 1) = '2' then least(2, newest) else newest end
where right(b.repo, 1) <> '1'""",
    "edges": "select repo, commit_id, unnest(parents) as parent from branching",
    "reached": """
select repo, commit_id from refs
union
select e.repo, e.parent from reached r join edges e on e.repo = r.repo and e.commit_id = r.commit_id
  join branching b on b.repo = e.repo and b.commit_id = e.parent""",
    "walked": """
select repo, commit_id, [struct_pack(age := -epoch_us(committed_at), id := commit_id)] as key
from refs join branching using (repo, commit_id)
union
select b.repo, b.commit_id, list_append(list_filter(w.key, lambda k: k > struct_pack(age := -epoch_us(b.committed_at),
  id := b.commit_id)), struct_pack(age := -epoch_us(b.committed_at), id := b.commit_id))
from walked w join edges e on e.repo = w.repo and e.commit_id = w.commit_id
  join branching b on b.repo = e.repo and b.commit_id = e.parent""",
    "styles": _styles(fv.MAX_STYLE_SIZE),
    "short_styles": _styles(MAX_STYLE),
    "ranked": f"""
select *, row_number() over w as position,
       list(substr(commit_id, 1, 7) || ' ' || {_line("message")})
         over (partition by repo order by committed_at desc, commit_key rows between 1 following and 5 following)
         as older
from commits where n_parents <= 1 window w as (partition by repo order by committed_at desc, commit_key)""",
    "recent": """
select repo, commit_key, commit_id, author_name, message, position,
       coalesce(array_to_string(older, chr(10)), '') as recent_commits_message from ranked""",
    "running": """
select *, coalesce(sum(length(patch_text)) over (partition by commit_key order by patch_idx
            rows between unbounded preceding and 1 preceding), 0) as before from patches""",
    "diffs": _diffs(fv.MAX_DIFF_SIZE),
    "short_diffs": _diffs(MAX_DIFF),
    "kept": f"""
select repo, commit_key, {_clean("message")} as commit_msg, recent_commits_message
from recent where position <= {fv.MAX_COMMITS} and not {_noise("message")} and not {_BOT}""",
    "records": """
select kept.repo, kept.commit_key, commit_msg, coalesce(change, '') as change, recent_commits_message,
       coalesce(license, 'Detection Failed: JSONDecodeError') as license, coalesce(code_style, '') as code_style,
       coalesce(files, []) as files, repo_source
from kept left join diffs using (commit_key) left join styles using (repo) left join licences using (repo)
     left join sources using (repo)""",
}
_RECURSIVE = {"reached", "walked"}
_NEEDS = {
    "repo_files": ["styled"],
    "styles": ["repo_files"],
    "short_styles": ["repo_files"],
    "ranked": ["commits"],
    "recent": ["ranked"],
    "running": ["patches"],
    "diffs": ["running"],
    "short_diffs": ["running"],
    "refs": ["branching"],
    "edges": ["branching"],
    "reached": ["refs", "edges"],
    "walked": ["refs", "edges"],
    "kept": ["recent"],
    "records": ["kept", "diffs", "styles", "licences", "sources"],
    "profile": ["grams"],
    "detected": ["profile"],
    "normal": ["kept"],
}


def _grams(view: str, source: str, key: str, text: str) -> str:
    """One row per trigram of a whole text, in time linear in its length."""
    return f"""
select {key}, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) as gram
from (select {key}, string_split({text}, '') as c from {source})"""


_VIEWS["grams"] = _grams("grams", "documents", "doc_id, lang", "text")
_VIEWS["profile"] = "select lang, gram, count(*) as n from grams group by lang, gram"


def _scores(grams: str, key: str) -> str:
    """Best language per key by smoothed naive Bayes in millionths of a nat, over trigram rows."""
    return f"""
select {key}, arg_min(lang, (loss, lang)) as lang
from (select {key}, lang, -sum(c * (coalesce(cast(floor(ln(2 * n + 1) * 1000000 + 0.5) as bigint), 0) + unseen)) as loss
      from (select {key}, gram, count(*) as c from {grams} group by {key}, gram)
           cross join (select lang, cast(floor(ln(0.5::double / mass) * 1000000 + 0.5) as bigint) as unseen
                       from (select lang, sum(n)::double + 0.5::double * (select count(distinct gram) from profile) as mass
                             from profile group by lang))
           left join profile using (lang, gram)
      group by {key}, lang)
group by {key}"""


def oracle(name: str, select: str, *needs: str, **extra: str) -> None:
    order: list[str] = []

    def visit(view: str) -> None:
        for below in _NEEDS.get(view, []):
            visit(below)
        if view not in order:
            order.append(view)

    for view in needs:
        visit(view)
    # Read more than once, so kept rather than expanded again; what names itself is kept as it is.
    parts = [f"{view} as {'' if view in _RECURSIVE else 'materialized '}({_VIEWS[view]})" for view in order]
    parts += [f"{view} as materialized ({text})" for view, text in extra.items()]
    ORACLES[name] = ("with recursive " + ",\n".join(parts) + "\n" if parts else "") + select


# --- sources and sinks -------------------------------------------------------------

oracle("jsonl_scan_skip", "select doc_id, text, lang from documents")
oracle("jsonl_roundtrip", "select doc_id, text, nullif(lang, 'fr') as lang from documents")
oracle(
    "jsonl_rejects",
    """with numbered as (select doc_id // 500 as bucket, doc_id, text, lang,
         9 * (row_number() over (partition by doc_id // 500 order by doc_id) - 1) as before from documents),
       broken as (select bucket, before, unnest([2, 4, 5, 6, 7, 8, 9]) as nth from numbered)
       select bucket, before + nth as line_no, case when nth = 2 then 'blank' else 'not a JSON record' end as reason from broken""",
)
oracle(
    "jsonl_ordered",
    """select repo, commit_key, row_number() over (partition by repo order by committed_at desc, commit_key) as position
       from commits""",
    "commits",
)
oracle(
    "jsonl_rerun",
    """select repo, commit_key, position, case when substr(repo, 4, 1) < '4' then 'rerun' else author_name end as author_name
       from (select *, row_number() over (partition by repo order by committed_at desc, commit_key) as position from commits)""",
    "commits",
)
oracle("jsonl_by_repo", "select repo, commit_key, author_name from commits", "commits")
oracle("repo_list_scan", "select full_name from repo_catalog", "repo_catalog")
oracle("repo_list_sink", "select distinct full_name from repo_catalog", "repo_catalog")

# --- catalogue -----------------------------------------------------------------------

oracle("catalog_filter", "select * from repo_catalog where stars > 1000 and not archived", "repo_catalog")
oracle(
    "top_repos",
    """select * from (select *, row_number() over (partition by language
                       order by stars desc, full_name, archived) as position
                     from repo_catalog where stars > 100 and language in ('en', 'fr', 'de'))
       where position <= 100""",
    "repo_catalog",
)
oracle("distinct_repos", "select distinct full_name from repo_catalog", "repo_catalog")
oracle(
    "exclude_substring",
    """select full_name, stars from repo_catalog r where not exists (
         select 1 from repo_catalog b where b.stars > 6000
         and contains(r.full_name, left(b.full_name, length(b.full_name) - 1)))""",
    "repo_catalog",
)
oracle(
    "exclude_exact",
    """select full_name, stars from repo_catalog
       where full_name not in (select full_name from repo_catalog where stars > 6000)""",
    "repo_catalog",
)
oracle(
    "repo_list_plan",
    """select distinct full_name from (select *, row_number() over (partition by language
                       order by stars desc, full_name, archived) as position
                     from repo_catalog where stars > 100 and language in ('en', 'fr', 'de')) r
       where position <= 100 and not exists (select 1 from repo_catalog b where b.stars > 6000
             and contains(r.full_name, left(b.full_name, length(b.full_name) - 1)))""",
    "repo_catalog",
)
oracle(
    "integrity_split",
    """select repo, case when repo not in (select repo from parented) then 'no commits'
                        when repo in (select repo from parented p where parent is not null and not exists
                             (select 1 from parented k where k.repo = p.repo and k.commit_id = p.parent))
                        then 'missing parent' else 'ok' end as reason
       from repositories""",
    "repositories",
    "parented",
)

oracle(
    "reachable_integrity",
    """select repo, case when repo not in (select repo from refs) then 'no HEAD'
                        when repo in (select e.repo from reached r join edges e using (repo, commit_id)
                             where e.parent not in (select commit_id from branching)) then 'missing parent'
                        else 'ok' end as reason
       from repositories""",
    "repositories",
    "reached",
)

# --- commits ---------------------------------------------------------------------------

oracle("reachable_commits", "select repo, commit_id from reached", "reached")
oracle(
    "walk_order",
    """select repo, commit_id, row_number() over (partition by repo order by key) as position
       from (select repo, commit_id, min(key) as key from walked group by repo, commit_id)""",
    "walked",
)

oracle("drop_merges", "select commit_key, n_parents from commits where n_parents <= 1", "commits")
oracle(
    "newest_per_repo",
    f"""select * from (select repo, commit_key, row_number() over (partition by repo
          order by committed_at desc, commit_key) as position from commits) where position <= {CAP}""",
    "commits",
)
_HISTORY = "select repo, commit_key, commit_id, position, recent_commits_message from recent"
oracle("recent_history", f"{_HISTORY} where position <= {CAP}", "recent")
oracle("recent_history_uncapped", _HISTORY, "recent")
oracle("drop_noise", f"select commit_key, message from commits where not {_noise('message')}", "commits")
oracle("drop_bots", f"select commit_key, author_name from commits where not {_BOT}", "commits")
oracle("clean_message", f"select commit_key, {_clean('message')} as commit_msg from commits", "commits")
oracle("py_strip", f"select doc_id, {_strip('text')} as stripped from documents")

# --- diffs -------------------------------------------------------------------------------

oracle("assemble_diff", "select commit_key, change from short_diffs", "short_diffs")
oracle("affected_files", "select commit_key, array_to_string(files, '|') as affected_files from short_diffs", "short_diffs")
oracle(
    "diff_of_kept_commits",
    """select commit_key, coalesce(change, '') as change, coalesce(array_to_string(files, '|'), '') as affected_files
       from commits left join diffs using (commit_key) where n_parents <= 1""",
    "commits",
    "diffs",
)
oracle("truncate_marked", f"select doc_id, {_cut('text', MAX_STYLE)} as cut from documents")

# --- repository facts and records -----------------------------------------------------------

oracle("code_style", "select repo, code_style from short_styles", "short_styles")
oracle("license_of_repo", "select repo, license from licences", "licences")
oracle("repo_source", "select repo, repo_source from repositories left join sources using (repo)", "repositories", "sources")
oracle(
    "repo_enrichment",
    """select repo, commit_key, coalesce(code_style, '') as code_style, license
       from commits left join styles using (repo) left join licences using (repo)""",
    "commits",
    "styles",
    "licences",
)
oracle(
    "commit_record",
    "select * exclude (files), array_to_string(files, '|') as affected_files from records",
    "records",
)
oracle(
    "count_by_repo",
    f"select repo, count(*) as n_rows from commits where n_parents <= 1 and not {_noise('message')} group by repo",
    "commits",
)

# --- text normalisation ----------------------------------------------------------------------

_odd = "text"
for _whole, _parts in (("é", "'e' || chr(769)"), ("è", "'e' || chr(768)"), ("ü", "'u' || chr(776)")):
    _odd = f"replace({_odd}, '{_whole}', {_parts})"
for _plain, _strange in (
    ("chr(10)", "chr(13) || chr(10)"),
    ("' '", "'  '"),
    ("'q'", "chr(8203) || chr(945) || chr(1076)"),
    ("'W'", "chr(128512)"),
):
    _odd = f"replace({_odd}, {_plain}, {_strange})"
_ODD = f"select doc_id, {_odd} as text from documents"
oracle("norm_nfc", "select doc_id, nfc_normalize(text) as text from odd", odd=_ODD)
oracle("strip_unlisted", f"select doc_id, {_unlisted('text')} as text from odd", odd=_ODD)
oracle("unify_newlines", f"select doc_id, {_newlines('text')} as text from odd", odd=_ODD)
oracle("squeeze_spaces", f"select doc_id, {_squeeze('text')} as text from odd", odd=_ODD)
# No NFKC in this SQL; on this text only the widened letters are affected, so undoing that is the result.
oracle("norm_nfkc_halfwidth", "select doc_id, nfc_normalize(text) as text from documents")
oracle(
    "normalize_fields",
    f"select doc_id, {_normalized('text')} as change, ' ' || chr(9) || ' ' as commit_msg, text as other from odd",
    odd=_ODD,
)

oracle(
    "jsonl_normalize",
    f"""select doc_id, {_normalized('text')} as commit_msg, n_chars as change, lang, source || '|' || text as deep
        from odd join (select doc_id, lang, source, n_chars from documents) using (doc_id)""",
    odd=_ODD,
)

# --- language ------------------------------------------------------------------------------------

oracle(
    "min_length",
    f"""select * from (select doc_id, case source when 'src1' then ' ' || chr(10) when 'src2' then ' ' || chr(10) || 'ab  '
          when 'src3' then ' abc' || chr(9) else text end as text from documents)
        where length({_strip('text')}) >= {fv.MIN_TARGET_LENGTH}""",
)
oracle("language_profile", "select lang, gram, n from profile", "profile")
_DETECT = "select doc_id, detected.lang as lang from documents left join detected using (doc_id)"
for _name in ("detect_language", "detect_language_shuffled"):
    oracle(
        _name,
        _DETECT,
        "grams",
        profile="select lang, gram, count(*) as n from grams where doc_id % 2 = 0 group by lang, gram",
        detected=_scores("grams", "doc_id"),
    )
oracle(
    "filter_language",
    f"""select conv_id, turn, role, text as target from conversations join detected using (conv_id, turn)
        where length({_strip('text')}) >= {fv.MIN_TARGET_LENGTH} and lang in ('en', 'de')""",
    "profile",
    turn_grams=_grams("turn_grams", "conversations", "conv_id, turn", _strip("text")),
    detected=_scores("turn_grams", "conv_id, turn"),
)

# --- samples -----------------------------------------------------------------------------------------

_SHAPES = """
select doc_id, case when source = 'src4' then ' x ' else text end as commit_msg,
       case when lang = 'fr' then null when lang = 'de' then '' else ' ' || text end as change,
       case when source = 'src5' then null when source = 'src6' then ' ' else source end as recent_commits_message,
       case when lang = 'es' then null when source = 'src7' then ' ' || chr(10) else lang || chr(10) end as code_style,
       case when source = 'src8' then '(none)' when lang = 'en' then source || ', ' || lang else '(none)' end as affected_files
from documents"""
_SHOWN = f"""
select doc_id, commit_msg, {_strip("coalesce(change, '(none)')")} as change,
       {_strip("coalesce(recent_commits_message, '(none)')")} as recent_commits_message,
       case when code_style is null or {_strip("code_style")} = '' then '(not specified)'
            else {_strip("code_style")} end as code_style, affected_files
from shapes"""


def _prompt(instruction: str) -> str:
    lead = f"{_literal(instruction)} || " if instruction else ""
    return f"""{lead}'Affected files: ' || affected_files || chr(10) || 'Diff (code changes): ' || change || chr(10) ||
        'Recent commit examples: ' || recent_commits_message || chr(10) || 'Code style guidelines: ' || code_style
        || chr(10) || 'Commit message:'"""


oracle("prompt_defaults", "select * from shown", shapes=_SHAPES, shown=_SHOWN)
for _name, _lead, _least in (("format_prompt", fv.INSTRUCTION, 3), ("format_prompt_bare", "", 1)):
    oracle(
        _name,
        f"""select doc_id, {_prompt(_lead)} as prompt, {_strip('commit_msg')} as target
            from shown where length({_strip('commit_msg')}) >= {_least}""",
        shapes=_SHAPES,
        shown=_SHOWN,
    )
oracle(
    "run_counters",
    f"""select count(*) as parsed, count(*) filter (where length({_strip('commit_msg')}) >= 3) as written
        from shapes""",
    shapes=_SHAPES,
)

# --- token rows -----------------------------------------------------------------------------------------

_PAIRS = """
select page_id, case when starts_with(url, 'https://m.') then repeat(url, 3) when starts_with(url, 'http:') then url
            else html || url end as prompt,
       case when starts_with(url, 'http:') then html || url when starts_with(url, 'https://m.') then html
            else list_extract(string_split(url, '/'), -1) end as target from pages"""


def _ids(text: str) -> str:
    """Code points; the split of an empty text is one empty string, which has none."""
    return f"list_transform(list_filter(string_split({text}, ''), lambda x: x <> ''), lambda x: unicode(x))"


_IDS = f"select page_id, {_ids('prompt')} as p, list_append({_ids(_strip('target'))}, {EOS}) as t from pairs"


def _fitted(length: int) -> str:
    return f"""
select * exclude (p, t), list_slice(p, len(p) - least(len(p), greatest({length - 1} - len(t), 0)) + 1, len(p)) as p,
       list_slice(t, 1, {length - 1}) as t from ids"""


def _padded(length: int) -> str:
    """Prompt ids ``p`` and target ids ``t`` to the three arrays, as joined strings."""
    joined = "array_to_string({}, ',')"
    gap = f"greatest({length} - 1 - len(p) - len(t), 0)"

    def fill(value: int, count: str) -> str:
        return f"list_transform(range({count}), lambda x: {value})"

    ids = f"list_concat([{BOS}], list_concat(p, list_concat(t, {fill(PAD, gap)})))"
    mask = f"list_concat({fill(1, '1 + len(p) + len(t)')}, {fill(0, gap)})"
    labels = f"list_concat({fill(-100, '1 + len(p)')}, list_concat(t, {fill(-100, gap)}))"
    return f"{joined.format(ids)} as input_ids, {joined.format(mask)} as attention_mask, {joined.format(labels)} as labels"


oracle(
    "token_ids",
    f"""select page_id, array_to_string({_ids('html')}, ',') as prompt_ids,
        array_to_string({_ids('url')}, ',') as target_ids from pages""",
)
oracle("append_eos", "select page_id, array_to_string(t, ',') as target_ids from ids", pairs=_PAIRS, ids=_IDS)
_ROWS = {"pairs": _PAIRS, "ids": _IDS, "fitted": _fitted(ROW_LENGTH)}
oracle(
    "fit_to_length",
    "select page_id, array_to_string(p, ',') as prompt_ids, array_to_string(t, ',') as target_ids from fitted",
    **_ROWS,
)
_ROWS["padded"] = f"select page_id, {_padded(ROW_LENGTH)} from fitted"
oracle("pad_and_mask", "select page_id, input_ids, attention_mask from padded", **_ROWS)
oracle("labels", "select page_id, labels from padded", **_ROWS)

# --- composites --------------------------------------------------------------------------------------------

oracle(
    "commit_history_samples",
    f"""select commit_key, 'Recent commit examples: ' || recent_commits_message || chr(10) || 'Commit message:' as prompt,
        {_clean('message')} as target from recent where position <= {fv.MAX_COMMITS} and not {_noise('message')}""",
    "recent",
)
_WRITTEN = {
    "cleaned": f"""select commit_key, {_normalized('commit_msg')} as commit_msg, {_normalized('change')} as change,
        {_normalized('recent_commits_message')} as recent_commits_message, {_normalized('code_style')} as code_style,
        files from records""",
    "message_grams": _grams("message_grams", "cleaned", "commit_key", "commit_msg"),
    "detected": _scores("message_grams", "commit_key"),
    "shown": f"""select commit_key, commit_msg as target, {_strip('change')} as change,
        {_strip('recent_commits_message')} as recent_commits_message,
        case when {_strip('code_style')} = '' then '(not specified)' else {_strip('code_style')} end as code_style,
        case when len(files) > 0 then array_to_string(files, ', ') else '(none)' end as affected_files
        from cleaned join detected using (commit_key) where lang = 'en' and length(commit_msg) >= 3""",
    "samples": f"select commit_key, {_prompt(fv.INSTRUCTION)} as prompt, target from shown",
}
oracle("history_to_training_samples", "select * from samples", "records", "profile", **_WRITTEN)
_WRITTEN["ids"] = f"select commit_key, {_ids('prompt')} as p, list_append({_ids('target')}, {EOS}) as t from samples"
_WRITTEN["fitted"] = _fitted(fv.MAX_TOKENS)
_WRITTEN["padded"] = f"select commit_key, {_padded(fv.MAX_TOKENS)} from fitted"
oracle(
    "history_to_token_rows",
    "select commit_key, md5(input_ids) as input_ids, md5(attention_mask) as attention_mask, md5(labels) as labels from padded",
    "records",
    "profile",
    **_WRITTEN,
)
