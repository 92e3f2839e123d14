"""The queries of ``queries.py`` in plain SQL, each from the raw tables.

Nothing here goes through the sample responses: a query that extracts rows from built HTML
or JSON is compared with the columns they were built from.
"""

from __future__ import annotations

REJECTED_POSTS = """
CASE WHEN doc_id % 11 = 0 THEN 'no_key' WHEN doc_id % 13 = 0 THEN 'bad_time' ELSE '' END"""


def host_no(src: str) -> str:
    """Image host number: first hex digit of the md5 of the source, modulo 4, plus 1."""
    return f"(CAST('0x' || substr(md5({src}), 1, 1) AS INTEGER) % 4 + 1)"


def avatar(user: str) -> str:
    return (
        f"CASE WHEN {user} % 5 <> 0 THEN 'https://img.example/a' || {user} || '_l.png' "
        f"ELSE 'https://pic1.zhimg.com/a' || {user} || '_l.jpg' END"
    )


def user_fields(user: str, headline: str, prefix: str = "") -> str:
    """Fields of a user item built from a user number."""
    return f"""
  CAST({user} AS VARCHAR) AS {prefix}zuid,
  'User ' || {user} AS {prefix}name,
  'https://people.example/u' || {user} AS {prefix}link,
  md5('u' || {user}) AS {prefix}hash,
  'u' || {user} AS {prefix}slug,
  'About u' || {user} AS {prefix}description,
  {headline} || {user} AS {prefix}headline,
  {avatar(user)} AS {prefix}avatar"""


SRC = "doc_id || '.jpg'"
REWRITTEN_SRC = f"'https://pic' || {host_no(SRC)} || '.zhimg.com/' || {SRC}"
CONTENT = """'<p>' || text || '</p>'
  || CASE WHEN doc_id % 2 = 0 THEN '<img alt="x" src="' || doc_id || '.jpg">' ELSE '' END
  || '<a href="https://x.example/p/' || doc_id || '?a=1">more</a>'"""
REWRITTEN = f"""'<p>' || text || '</p>'
  || CASE WHEN doc_id % 2 = 0 THEN '<img alt="x" src="' || {REWRITTEN_SRC} || '">' ELSE '' END
  || '<a href="https://reader.example/article/' || doc_id || '/">more</a>'"""
COVER = "CASE WHEN doc_id % 3 = 0 THEN 'c.jpg' ELSE '' END"
FIRST_COVER = f"""CASE WHEN doc_id % 3 = 0 THEN 'c.jpg'
  WHEN doc_id % 2 = 0 THEN {REWRITTEN_SRC} ELSE '' END"""

# Posts: documents with the event of the same number, ranked in their source, 20 per page.
# Sources whose number is 6 modulo 7 have no creator; the author stands in.
POSTS = f"""
WITH RECURSIVE docs AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, e.user_id, e.ts,
         CAST(substr(d.source, 4) AS BIGINT) AS src_no,
         row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id DESC) - 1 AS rn
  FROM documents d JOIN events e ON d.doc_id = e.event_id),
sources AS (
  SELECT s.source, s.n, s.doc_id AS first_doc, e.user_id AS creator_no,
         CAST(substr(s.source, 4) AS BIGINT) AS src_no
  FROM (SELECT source, count(*) AS n, min(doc_id) AS doc_id FROM documents GROUP BY source) s
  JOIN events e ON s.doc_id = e.event_id),
posts AS (
  SELECT docs.*, rn // 20 AS page, CAST(rn % 20 AS INTEGER) AS pos,
         (rn // 20) * 1048576 + docs.src_no AS resp_seq,
         md5(text) AS token, md5(md5(text)) AS md5, 'Post ' || doc_id AS title,
         'https://zhuanlan.zhihu.com/p/' || md5(text) AS link,
         lang || ':' || n_chars AS summary, {COVER} AS cover, {CONTENT} AS content,
         strftime(ts, '%Y-%m-%dT%H:%M:%S+08:00') AS published,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS created,
         docs.src_no % 7 <> 6 AS has_creator,
         CASE WHEN docs.src_no % 7 <> 6 THEN creator_no ELSE user_id END AS made_by
  FROM docs JOIN sources USING (source)),
stored_articles AS (
  SELECT md5(md5(text)) AS md5, min(doc_id) + 1 AS id
  FROM documents WHERE doc_id % 3 = 0 GROUP BY 1),
old_articles AS (
  SELECT md5(md5(text)) AS md5, min(doc_id) + 1 AS id
  FROM documents WHERE doc_id < (SELECT count(*) / 2 FROM documents) GROUP BY 1),
users AS (
  SELECT DISTINCT user_id, user_id + 1 AS id, 'u' || user_id AS slug,
         CASE WHEN user_id % 7 <> 0 THEN user_id % 3 = 0 END AS crawl_column,
         CASE WHEN user_id % 7 <> 0 THEN user_id % 2 = 0 END AS crawl_follow
  FROM events),
stored_users AS (SELECT * FROM users WHERE user_id % 3 = 0),
stored_columns AS (
  SELECT src_no + 1 AS id, source AS slug,
         CASE WHEN src_no % 8 = 0 THEN TIMESTAMP '2024-01-01 00:00:00'
              WHEN src_no % 16 = 4 THEN TIMESTAMP '2034-01-01 00:00:00' END AS last_update_time
  FROM sources WHERE src_no % 4 = 0),
first_posts AS (
  SELECT * FROM posts
  QUALIFY row_number() OVER (PARTITION BY md5 ORDER BY resp_seq, pos) = 1),
new_posts AS (SELECT * FROM first_posts WHERE md5 NOT IN (SELECT md5 FROM stored_articles))
"""

FOLLOWS = """
WITH RECURSIVE follows AS (
  SELECT DISTINCT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
users AS (
  SELECT DISTINCT user_id, user_id + 1 AS id, 'u' || user_id AS slug,
         CASE WHEN user_id % 7 <> 0 THEN user_id % 3 = 0 END AS crawl_column,
         CASE WHEN user_id % 7 <> 0 THEN user_id % 2 = 0 END AS crawl_follow
  FROM events),
stored_users AS (SELECT * FROM users WHERE user_id % 3 = 0),
placed AS (
  SELECT user_id, k, k % 2 AS side,
         row_number() OVER (PARTITION BY user_id, k % 2 ORDER BY k) - 1 AS rn
  FROM follows),
items AS (
  SELECT *, CAST(rn % 20 AS INTEGER) AS pos,
         ((rn // 20) * 2 + side) * 4294967296 + user_id AS resp_seq
  FROM placed)
"""

SOURCES = """
WITH sources AS (
  SELECT s.source, s.n, s.doc_id AS first_doc, e.user_id AS creator_no,
         CAST(substr(s.source, 4) AS BIGINT) AS src_no
  FROM (SELECT source, count(*) AS n, min(doc_id) AS doc_id FROM documents GROUP BY source) s
  JOIN events e ON s.doc_id = e.event_id)
"""

SUPPLIERS = """
WITH proxies AS (
  SELECT s_suppkey, s_nationkey, '10.0.' || s_nationkey || '.' || (s_suppkey % 250) AS host,
         CAST(s_suppkey + 8000 AS VARCHAR) AS port,
         CASE s_suppkey % 3 WHEN 0 THEN 'HTTP' WHEN 1 THEN 'https' ELSE 'HTTPS' END AS protocol,
         CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 2 END AS code,
         CASE WHEN s_suppkey % 5 = 0 THEN 404 ELSE 200 END AS status,
         abs(s_acctbal) / 2500 AS elapsed,
         (s_suppkey // 100) * 1000 + s_nationkey AS page_id,
         CAST(row_number() OVER (
           PARTITION BY s_nationkey, s_suppkey // 100 ORDER BY s_suppkey) - 1 AS INTEGER) AS pos
  FROM supplier),
stored AS (
  SELECT min(s_suppkey) + 1 AS id, host FROM proxies WHERE s_nationkey % 2 = 0 GROUP BY host)
"""

# Words of every turn, the items of one page each.
WORDS = """
WITH words AS (
  SELECT conv_id, turn, role, turn * 4294967296 + conv_id AS resp_seq, w AS slug,
         CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) - 1 AS INTEGER) AS pos
  FROM (SELECT conv_id, turn, role, regexp_split_to_array(text, '[ \\n]+') AS ws FROM conversations),
       unnest(ws) WITH ORDINALITY AS u(w, i)
  WHERE w <> '')
"""

# Events as keyed items that land in four ranges.
ITEMS = """
WITH items AS (
  SELECT event_id AS seq, ts, 'u' || user_id AS slug,
         user_id || '-' || json_extract_string(props, '$.k') AS key,
         CAST(event_id // ((SELECT max(event_id) FROM events) // 4 + 1) AS INTEGER) AS batch
  FROM events),
stored AS (SELECT key, min(seq) AS seq FROM items WHERE slug LIKE '%5' GROUP BY key),
new_items AS (
  SELECT key, min(seq) AS seq, min(batch) AS batch FROM items
  WHERE key NOT IN (SELECT key FROM stored) GROUP BY key)
"""

PAGES = f"""
WITH art AS (
  SELECT page_id, html, page_id || '.jpg' AS src,
         'https://pic' || {host_no("page_id || '.jpg'")} || '.zhimg.com/' || page_id || '.jpg' AS new_src,
         '<a href="https://x.example/p/' || page_id || '?a=1">' AS tail
  FROM pages)
"""


def fields(alias: str, names: str = "zuid name link hash slug description headline avatar") -> str:
    return ", ".join(f"{alias}_{n}" for n in names.split())


POST_ITEM = f"""title, content, summary, cover, token, md5, link, published,
  {user_fields('user_id', "'h'", 'author_')}"""

# The creator's headline starts with b, an author's with h.
PREFERRED = "CASE WHEN has_creator AND made_by = user_id THEN 'b' ELSE 'h' END"
CREATOR = "CASE WHEN has_creator THEN 'b' ELSE 'h' END"

COLUMN_AVATAR = """CASE WHEN src_no % 5 <> 0
  THEN 'https://img.example/c' || src_no || '_l.png'
  ELSE 'https://pic2.zhimg.com/c' || src_no || '_l.jpg' END"""

# New users of the full load: author before creator within a post, first write wins.
E1_USERS = f"""
, candidates AS (
  SELECT user_id AS no, {PREFERRED} AS h, resp_seq, pos, 0 AS role FROM posts
  UNION ALL SELECT made_by, {CREATOR}, resp_seq, pos, 1 FROM posts),
fresh_users AS (
  SELECT (SELECT max(id) FROM stored_users)
           + row_number() OVER (ORDER BY md5('u' || no)) AS id, no, h
  FROM (SELECT * FROM candidates WHERE no NOT IN (SELECT user_id FROM stored_users)
        QUALIFY row_number() OVER (PARTITION BY no ORDER BY resp_seq, pos, role) = 1)),
all_users AS (
  SELECT id, no FROM fresh_users UNION ALL SELECT id, user_id FROM stored_users)"""

E1_COLUMNS = f"""{E1_USERS},
fresh_columns AS (
  SELECT (SELECT max(id) FROM stored_columns) + row_number() OVER (ORDER BY md5(source)) AS id,
         source, src_no, u.id AS creator_id
  FROM (SELECT source, src_no, made_by FROM posts
        WHERE source NOT IN (SELECT slug FROM stored_columns)
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY resp_seq, pos) = 1) p
  JOIN all_users u ON u.no = p.made_by),
all_columns AS (
  SELECT id, source AS slug FROM fresh_columns UNION ALL SELECT id, slug FROM stored_columns)"""

ARTICLE = f"""title, md5, {REWRITTEN} AS content, summary, {FIRST_COVER} AS cover, link, token,
  '' AS keywords, u.id AS author_id, c.id AS belong_id, created"""

# Single pages: every document is one, in doc_id order; authors keep their own profile.
E2 = f"""
, pages1 AS (SELECT * FROM posts),
candidates AS (
  SELECT user_id AS no, doc_id, 0 AS role FROM pages1
  UNION ALL SELECT made_by, doc_id, 1 FROM pages1),
fresh_users AS (
  SELECT (SELECT max(id) FROM stored_users)
           + row_number() OVER (ORDER BY md5('u' || no)) AS id, no
  FROM (SELECT DISTINCT no FROM candidates WHERE no NOT IN (SELECT user_id FROM stored_users))),
all_users AS (
  SELECT id, no FROM fresh_users UNION ALL SELECT id, user_id FROM stored_users),
all_columns AS (
  SELECT (SELECT max(id) FROM stored_columns) + row_number() OVER (ORDER BY md5(source)) AS id,
         source AS slug
  FROM (SELECT DISTINCT source FROM pages1
        WHERE has_creator AND source NOT IN (SELECT slug FROM stored_columns))
  UNION ALL SELECT id, slug FROM stored_columns),
fresh AS (
  SELECT * FROM pages1 WHERE md5 NOT IN (SELECT md5 FROM stored_articles)
  QUALIFY row_number() OVER (PARTITION BY md5 ORDER BY doc_id) = 1),
loaded AS (
  SELECT (SELECT max(id) FROM stored_articles) + row_number() OVER (ORDER BY md5(md5)) AS id, *
  FROM fresh)"""

# Incremental load of ten columns drawn by md5(slug || 7).
E3 = """
, drawn AS (SELECT source FROM sources ORDER BY md5(source || '7'), source LIMIT 10),
planned AS (SELECT p.* FROM posts p JOIN drawn USING (source)),
cuts AS (
  SELECT source, min(page) AS cut FROM planned
  WHERE md5 IN (SELECT md5 FROM old_articles) GROUP BY source),
kept AS (
  SELECT p.* FROM planned p LEFT JOIN cuts USING (source)
  WHERE (cut IS NULL OR page <= cut) AND source IN (SELECT slug FROM stored_columns)),
fresh_users AS (
  SELECT (SELECT max(id) FROM stored_users)
           + row_number() OVER (ORDER BY md5('u' || no)) AS id, no
  FROM (SELECT DISTINCT user_id AS no FROM kept
        WHERE user_id NOT IN (SELECT user_id FROM stored_users))),
all_users AS (
  SELECT id, no FROM fresh_users UNION ALL SELECT id, user_id FROM stored_users)"""

FOLLOW_CRAWL = """
, waiting AS (SELECT user_id FROM stored_users WHERE NOT crawl_follow),
idle AS (
  SELECT user_id FROM stored_users WHERE user_id NOT IN (SELECT user_id FROM waiting)),
edges AS (
  SELECT user_id AS src, user_id + k AS dst FROM follows
  WHERE user_id NOT IN (SELECT user_id FROM idle)),
reached(no) AS (
  SELECT user_id FROM waiting
  UNION SELECT dst FROM reached JOIN edges ON no = src),
crawled AS (SELECT no FROM reached WHERE no NOT IN (SELECT user_id FROM idle)),
done AS (
  SELECT no FROM crawled WHERE no IN (
    SELECT user_id FROM follows GROUP BY user_id HAVING count(DISTINCT k % 2) = 2)),
fresh AS (
  SELECT (SELECT max(id) FROM stored_users) + row_number() OVER (ORDER BY md5('u' || no)) AS id, *
  FROM (SELECT user_id + k AS no, 'Member ' || (user_id + k) || ' of ' || user_id AS name
        FROM items WHERE user_id IN (SELECT no FROM crawled)
          AND user_id + k NOT IN (SELECT user_id FROM stored_users)
        QUALIFY row_number() OVER (PARTITION BY user_id + k ORDER BY resp_seq, pos) = 1))"""

SMALL_MESSAGE = "'[2024-05-06 07:08:09]抓取专栏' || source || '文章成功，抓取数目: ' || count(*)"

ORACLES: dict[str, str] = {
    "read_pages": "SELECT page_id, url, 200 AS status, html FROM pages",
    "read_api": """
SELECT 'https://www.zhihu.com/api/v4/members/conv' || conv_id || '/followers?limit=20&offset='
         || 20 * turn AS url,
       CAST(len(list_filter(regexp_split_to_array(text, '[ \\n]+'), lambda w: w <> '')) AS INTEGER) AS n_rows,
       turn = max(turn) OVER (PARTITION BY conv_id) AS is_end
FROM conversations""",
    "read_store": f"""{FOLLOWS}
SELECT id, slug, md5(slug) AS hash, crawl_follow, '2020-01-01 00:00:00' AS created FROM users""",
    "set_members": "SELECT DISTINCT source AS slug FROM documents",
    "write_star": f"""{POSTS}
SELECT md5, title, 'Stored ' || user_id AS author, c.id AS belong_id
FROM posts LEFT JOIN stored_columns c ON c.slug = source""",
    "html_table_rows": f"{SUPPLIERS} SELECT page_id, pos, host, port, protocol FROM proxies",
    "embedded_json": """
SELECT doc_id AS page_id, md5(text) AS tokens, 'u' || user_id AS slugs, false AS broken
FROM documents JOIN events ON doc_id = event_id""",
    "repair_json_field": """
SELECT doc_id, '{"id":' || doc_id || ',"updated":" ","canComment":true}' AS fixed FROM documents""",
    "flatten_post_state": f"""{POSTS}
SELECT doc_id AS page_id, CASE WHEN has_creator THEN source END AS column_slug,
  title, content, summary, cover, token, md5, link, published,
  {user_fields('user_id', "'h'", 'author_').replace(avatar('user_id'), "'https://img.example/u' || user_id")}
FROM posts""",
    "explode_posts": f"""{POSTS}
SELECT resp_seq, pos, source AS column_slug, CAST(page * 20 AS INTEGER) AS offset, {POST_ITEM}
FROM posts""",
    "explode_members": f"""{WORDS}
SELECT resp_seq, pos, conv_id || '-' || turn || '-' || pos AS zuid, 'Member ' || slug AS name,
       'https://www.zhihu.com/people/' || slug AS link, md5(slug) AS hash, slug,
       '' AS description, role AS headline, 'https://img.example/' || slug AS avatar
FROM words""",
    "explode_recommendations": f"""{SOURCES}
, listed AS (
  SELECT src_no // 13 AS resp_seq, CASE WHEN src_no % 13 <> 5 THEN source ELSE '' END AS slug,
         CAST(row_number() OVER (PARTITION BY src_no // 13 ORDER BY src_no) - 1 AS INTEGER) AS pos
  FROM sources)
SELECT resp_seq, pos, slug, 'https://zhuanlan.zhihu.com/' || slug AS link, md5(slug) AS hash
FROM listed""",
    "flatten_column_info": f"""{SOURCES}
, made AS (SELECT *, CASE WHEN src_no % 7 <> 6 THEN creator_no END AS c FROM sources)
SELECT source AS slug, 'Column ' || src_no AS name,
  'https://zhuanlan.zhihu.com/' || source AS link, md5(source) AS hash,
  'All of ' || source AS description, {COLUMN_AVATAR} AS avatar, CAST(n AS INTEGER) AS total,
  {user_fields('c', "'b'", 'creator_').replace(avatar('c'), f"CASE WHEN c IS NOT NULL THEN {avatar('c')} END")}
FROM made""",
    "explode_tags": """
SELECT doc_id AS page_id, md5(md5(text)) AS md5, pos, CASE pos WHEN 0 THEN lang ELSE source END AS name
FROM documents, (VALUES (0), (1)) AS t(pos)""",
    "md5_key": """
SELECT doc_id, md5(text) AS text_key, md5(CAST(doc_id AS VARCHAR)) AS id_key FROM documents""",
    "build_link": f"""{FOLLOWS}
SELECT slug, 'https://www.zhihu.com/people/' || slug AS people,
       'https://zhuanlan.zhihu.com/' || slug AS "column",
       'https://zhuanlan.zhihu.com/p/' || slug AS article FROM users""",
    "avatar_url": f"""{FOLLOWS}
SELECT slug,
  CASE WHEN id % 2 = 0 THEN 'https://img.example/l/' || md5(slug) || '.png'
       ELSE 'https://pic1.zhimg.com/' || md5(slug) || '_l.jpg' END AS large,
  CASE WHEN id % 2 = 0 THEN 'https://img.example/s/' || md5(slug) || '.png'
       ELSE 'https://pic2.zhimg.com/' || md5(slug) || '_s.jpg' END AS small
FROM users""",
    "slug_from_url": """
SELECT page_id, list_extract(string_split(trim(url, '/'), '/'), -1) AS slug FROM pages""",
    "offset_from_url": """
SELECT 'https://www.zhihu.com/api/v4/members/conv' || conv_id || '/followers?limit=20&offset='
         || 20 * turn AS url, CAST(20 * turn AS INTEGER) AS "offset" FROM conversations""",
    "parse_published": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S')
         || CASE event_id % 3 WHEN 0 THEN '+08:00' WHEN 1 THEN 'Z' ELSE '+09:00' END AS published,
       CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS wall_clock
FROM events""",
    "encode_protocol": f"{SUPPLIERS} SELECT host, port, protocol, code FROM proxies",
    "decode_choice": """
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 1 THEN 'HTTP' WHEN 2 THEN 'HTTPS' ELSE '' END AS name,
       s_suppkey % 4 IN (1, 2) AS is_choice FROM supplier""",
    "proxy_address": f"""{SUPPLIERS}
SELECT lower(protocol) AS scheme, host || ':' || port AS address FROM proxies""",
    "with_defaults": f"""{SOURCES}
SELECT source AS slug, CAST(n AS INTEGER) AS total,
       CASE WHEN src_no % 7 <> 6 THEN 'User ' || creator_no ELSE 'nobody' END AS creator_name
FROM sources""",
    "stamp": f"""{FOLLOWS}
SELECT slug, '2024-05-06 07:08:09' AS created, '2024-05-06 07:08:09' AS modified FROM users""",
    "html_unescape": """
SELECT page_id, replace(replace(replace(replace(
  html, '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&') AS text
FROM pages""",
    "rewrite_images": f"""{PAGES}
SELECT page_id, html || CASE WHEN page_id % 2 = 0 THEN '<img src="' || new_src || '">' ELSE '' END
         || tail AS html FROM art""",
    "cover_or_first_image": f"""{PAGES}
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'c.jpg'
  WHEN page_id % 2 = 0 THEN new_src ELSE '' END AS cover FROM art""",
    "rewrite_article_links": f"""{PAGES}
SELECT page_id, html || CASE WHEN page_id % 2 = 0 THEN '<img src="' || src || '">' ELSE '' END
         || '<a href="https://reader.example/article/' || page_id || '/">' AS html FROM art""",
    "available_proxies": f"""{SUPPLIERS}
SELECT host, port, protocol FROM proxies WHERE status = 200 AND elapsed <= 2""",
    "dead_links": f"""{SUPPLIERS}
SELECT DISTINCT host FROM proxies
WHERE host NOT IN (SELECT host FROM proxies WHERE status = 404)""",
    "pending_users": f"{FOLLOWS} SELECT slug, id FROM users WHERE crawl_follow = false",
    "split_rejects": f"SELECT doc_id, {REJECTED_POSTS} AS reject_reason FROM documents",
    "resolve_author": f"""{POSTS}
SELECT title, 'u' || p.user_id AS author_slug, u.id AS author_id
FROM posts p LEFT JOIN stored_users u USING (user_id)""",
    "resolve_creator": f"""{POSTS}
SELECT title, 'u' || made_by AS creator_slug, u.id AS creator_id
FROM posts p LEFT JOIN stored_users u ON u.user_id = made_by""",
    "resolve_column": f"""{POSTS}
SELECT title, source AS column_slug, c.id AS belong_id
FROM posts LEFT JOIN stored_columns c ON c.slug = source""",
    "load_fact": f"""{POSTS}
SELECT title, md5, u.id AS author_id, c.id AS belong_id
FROM posts p LEFT JOIN stored_users u USING (user_id) LEFT JOIN stored_columns c ON c.slug = source""",
    "require_column": f"""{POSTS}
SELECT title, c.id AS belong_id, CASE WHEN c.id IS NULL THEN 'unknown_column' ELSE '' END AS reject_reason
FROM posts LEFT JOIN stored_columns c ON c.slug = source""",
    "known_members": f"""{POSTS}
SELECT title, source AS column_slug FROM posts WHERE source IN (SELECT slug FROM stored_columns)""",
    "unknown_members": f"""{POSTS}
SELECT title, source AS column_slug FROM posts
WHERE source NOT IN (SELECT slug FROM stored_columns)""",
    "prefer_creator_profile": f"""{POSTS}
SELECT title, {user_fields('user_id', PREFERRED, 'author_')} FROM posts""",
    "attach_column": f"""{POSTS}
SELECT title, 'Column ' || src_no AS column_name, {COLUMN_AVATAR} AS column_avatar,
  {user_fields('made_by', CREATOR, 'creator_')} FROM posts""",
    "tag_bridge": """
WITH topics AS (
  SELECT DISTINCT md5(md5(text)) AS md5, unnest([lang, source]) AS name FROM documents),
tags AS (
  SELECT name, row_number() OVER (ORDER BY md5(name)) AS tag_id
  FROM (SELECT DISTINCT name FROM topics)),
stored AS (
  SELECT md5(md5(text)) AS md5, min(doc_id) + 1 AS zharticle_id
  FROM documents WHERE doc_id % 3 = 0 GROUP BY 1)
SELECT row_number() OVER (ORDER BY md5(zharticle_id || ':' || tag_id)) AS id, zharticle_id, tag_id, name
FROM topics JOIN stored USING (md5) JOIN tags USING (name)""",
    "count_articles": f"{POSTS} SELECT count(*) AS n_articles FROM stored_articles",
    "last_update_per_column": f"""{POSTS}
SELECT slug, strftime(greatest(max(last_update_time), max(date_trunc('second', ts))), '%Y-%m-%d %H:%M:%S') AS last_update
FROM stored_columns LEFT JOIN posts ON slug = source GROUP BY slug""",
    "max_id": f"{POSTS} SELECT max(id) AS max_id FROM stored_articles",
    "crawl_summary": f"""
SELECT source AS column_slug, count(*) AS n_items, {SMALL_MESSAGE} AS message
FROM documents GROUP BY source""",
    "new_article_feed": f"""{POSTS}
, numbered AS (SELECT *, row_number() OVER (ORDER BY resp_seq, pos) AS no FROM new_posts)
SELECT (no - 1) // 10 AS batch_no, CAST(count(*) AS INTEGER) AS n_new,
       string_agg('https://reader.example/article/' || token, chr(10) ORDER BY no) AS links,
       string_agg(md5, ',' ORDER BY no) AS md5s
FROM numbered GROUP BY 1""",
    "first_write_wins": f"{POSTS} SELECT md5, title, content FROM first_posts",
    "until_first_seen": f"""{POSTS}
, cuts AS (
  SELECT source, min(page) AS cut FROM posts
  WHERE md5 IN (SELECT md5 FROM old_articles) GROUP BY source)
SELECT title, source AS column_slug, page FROM posts LEFT JOIN cuts USING (source)
WHERE cut IS NULL OR page <= cut""",
    "assign_ids": f"""{FOLLOWS}
SELECT slug, (SELECT max(id) FROM stored_users) + row_number() OVER (ORDER BY md5(slug)) AS id
FROM users WHERE user_id % 3 <> 0""",
    "take_pending": f"""{FOLLOWS}
SELECT id, slug FROM users WHERE crawl_column = false ORDER BY id LIMIT 5""",
    "union_members": f"""{FOLLOWS}
SELECT 'u' || no AS slug, name, 'https://www.zhihu.com/people/u' || no AS link, md5('u' || no) AS hash
FROM (SELECT user_id + k AS no, 'Member ' || (user_id + k) || ' of ' || user_id AS name FROM items
      QUALIFY row_number() OVER (PARTITION BY user_id + k ORDER BY resp_seq, pos) = 1)""",
    "union_columns": f"""{FOLLOWS}
SELECT 'c' || (user_id + k) AS slug, 'https://zhuanlan.zhihu.com/c' || (user_id + k) AS link,
       md5('c' || (user_id + k)) AS hash, min(resp_seq) AS resp_seq
FROM items GROUP BY user_id + k""",
    "discoverable_columns": f"""{SOURCES}
SELECT source AS slug FROM sources WHERE src_no % 13 <> 5 AND src_no % 4 <> 0""",
    "insert_if_absent": f"{POSTS} SELECT md5, title, link FROM new_posts",
    "flag_new": f"""{POSTS}
SELECT title, md5, title IN (SELECT title FROM new_posts) AS is_new FROM posts""",
    "upsert_proxies": f"""{SUPPLIERS}
, fresh AS (
  SELECT * FROM proxies QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id, pos) = 1)
SELECT id, host, 1 AS port, 2 AS protocol, true AS available, '2020-01-01 00:00:00' AS created FROM stored
UNION ALL
SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY md5(host)), host,
       CAST(port AS INTEGER), code, true, '2024-05-06 07:08:09'
FROM fresh WHERE host NOT IN (SELECT host FROM stored)""",
    "mark_done": f"""{FOLLOWS}
SELECT slug, CASE WHEN id % 5 = 0 THEN true ELSE crawl_follow END AS crawl_follow, crawl_column
FROM users""",
    "dequeue": f"{SOURCES} SELECT source AS slug FROM sources WHERE src_no % 4 <> 0",
    "pop_random": f"""{SOURCES}
SELECT source AS slug, row_number() OVER (ORDER BY md5(source || '7'), source) <= 5 AS popped
FROM sources""",
    "offset_plan": f"""{SOURCES}
SELECT source AS slug, 20 * page AS "offset",
       'https://zhuanlan.zhihu.com/api/columns/' || source || '/posts?limit=20&offset=' || 20 * page AS url
FROM sources, unnest(range(CAST(ceil(n / 20.0) AS BIGINT) + 1)) AS t(page)""",
    "cursor_pages": """
WITH p AS (
  SELECT 'https://www.zhihu.com/api/v4/members/conv' || conv_id || '/followers?limit=20&offset=' AS u,
         turn FROM conversations)
SELECT u || '0' AS root, u || 20 * turn AS url, turn AS hop FROM p""",
    "seed_urls": f"""{FOLLOWS}
SELECT slug, endpoint, 'https://www.zhihu.com/api/v4/members/' || slug || '/' || path
         || '?limit=20&offset=0' AS url
FROM users, (VALUES ('followers', 'followers'), ('followees', 'followees'),
                    ('contributions', 'column-contributions'),
                    ('following', 'following-columns')) AS t(endpoint, path)""",
    "random_plan": """
WITH drawn AS (
  SELECT page_id, CAST(draw AS INTEGER) AS draw,
    CAST(13 + CAST('0x' || substr(md5('7|limit|' || page_id || '|' || draw), 1, 7) AS BIGINT) % 28 AS INTEGER) AS "limit",
    CAST(CAST('0x' || substr(md5('7|offset|' || page_id || '|' || draw), 1, 7) AS BIGINT) % 101 AS INTEGER) AS "offset",
    CAST(CAST('0x' || substr(md5('7|seed|' || page_id || '|' || draw), 1, 7) AS BIGINT) % 101 AS INTEGER) AS seed
  FROM pages, unnest(range(1, 11)) AS t(draw))
SELECT *, 'https://zhuanlan.zhihu.com/api/recommendations/columns?limit=' || "limit"
  || '&offset=' || "offset" || '&seed=' || seed AS url FROM drawn""",
    "expand_frontier": f"""{FOLLOWS}
, walk(no, depth) AS (
  SELECT min(user_id), 0 FROM users
  UNION SELECT no + k, depth + 1 FROM walk JOIN follows ON no = user_id WHERE depth < 64)
SELECT 'u' || no AS user, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY no""",
    "append_batches": f"{ITEMS} SELECT seq, key, batch FROM items",
    "stream_insert_if_absent": f"""{ITEMS}
SELECT seq, key, batch FROM new_items UNION ALL SELECT seq, key, -1 FROM stored""",
    "stream_dedupe": f"{ITEMS} SELECT key, min(batch) AS batch FROM items GROUP BY key",
    "stream_last_update": f"""{ITEMS}
SELECT slug, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_update FROM items GROUP BY slug""",
    "stream_batch_feed": f"""{ITEMS}
, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY batch ORDER BY seq) AS no FROM new_items)
SELECT batch, (no - 1) // 10 AS batch_no, CAST(count(*) AS INTEGER) AS n_new,
       string_agg('https://reader.example/article/' || key, chr(10) ORDER BY no) AS links,
       string_agg(md5(key), ',' ORDER BY no) AS md5s
FROM numbered GROUP BY batch, (no - 1) // 10""",
    "ingest_articles": f"""{POSTS}{E1_COLUMNS}
SELECT (SELECT max(id) FROM stored_articles) + row_number() OVER (ORDER BY md5(md5)) AS id, {ARTICLE}
FROM new_posts JOIN all_users u ON u.no = user_id JOIN all_columns c ON c.slug = source""",
    "ingest_articles_users": f"""{POSTS}{E1_USERS}
SELECT id, {user_fields('no', 'h')}, false AS crawl_column, false AS crawl_follow FROM fresh_users""",
    "ingest_articles_columns": f"""{POSTS}{E1_COLUMNS}
SELECT id, 'Column ' || src_no AS name, 'https://zhuanlan.zhihu.com/' || source AS link,
       md5(source) AS hash, source AS slug, 'All of ' || source AS description,
       {COLUMN_AVATAR} AS avatar, creator_id FROM fresh_columns""",
    "ingest_single_articles": f"""{POSTS}{E2}
SELECT l.id, {ARTICLE}
FROM loaded l JOIN all_users u ON u.no = user_id
LEFT JOIN all_columns c ON c.slug = source AND has_creator""",
    "ingest_single_articles_tags": f"""{POSTS}{E2}
, topics AS (SELECT id AS zharticle_id, unnest([lang, source]) AS name FROM loaded),
tags AS (
  SELECT name, row_number() OVER (ORDER BY md5(name)) AS tag_id
  FROM (SELECT DISTINCT name FROM topics))
SELECT zharticle_id, tag_id, name FROM topics JOIN tags USING (name)""",
    "ingest_incremental": f"""{POSTS}{E3}
SELECT (SELECT max(id) FROM old_articles) + row_number() OVER (ORDER BY md5(md5)) AS id, {ARTICLE}
FROM (SELECT * FROM kept WHERE md5 NOT IN (SELECT md5 FROM old_articles)
      QUALIFY row_number() OVER (PARTITION BY md5 ORDER BY resp_seq, pos) = 1)
JOIN all_users u ON u.no = user_id JOIN stored_columns c ON c.slug = source""",
    "ingest_incremental_columns": f"""{POSTS}{E3}
SELECT slug, strftime(greatest(max(last_update_time), max(date_trunc('second', ts))), '%Y-%m-%d %H:%M:%S') AS last_update
FROM stored_columns LEFT JOIN kept ON slug = source GROUP BY slug""",
    "crawl_follow_graph": f"""{FOLLOWS}{FOLLOW_CRAWL}
SELECT id, slug, 'Stored ' || user_id AS name,
       CASE WHEN user_id IN (SELECT no FROM done) THEN true ELSE crawl_follow END AS crawl_follow,
       crawl_column
FROM stored_users
UNION ALL
SELECT id, 'u' || no, name, no IN (SELECT no FROM done), false FROM fresh""",
    "crawl_follow_graph_resumed": f"""{FOLLOWS}{FOLLOW_CRAWL}
SELECT slug, CASE WHEN user_id IN (SELECT no FROM done) THEN true ELSE crawl_follow END AS crawl_follow,
       crawl_column
FROM stored_users
UNION ALL
SELECT 'u' || no, no IN (SELECT no FROM done), false FROM fresh""",
    "unseen_responses": f"""{FOLLOWS}
SELECT DISTINCT resp_seq FROM items JOIN users USING (user_id) WHERE crawl_follow = false""",
    "ingest_articles_queue": f"""{POSTS}{E1_COLUMNS}
SELECT source AS slug FROM sources
WHERE src_no % 9 <> 4 AND src_no % 4 <> 0
  AND (src_no % 11 = 7 OR source NOT IN (SELECT source FROM fresh_columns))""",
    "crawl_follow_graph_rejects": f"""{FOLLOWS}{FOLLOW_CRAWL}
SELECT DISTINCT resp_seq, 'broken_body' AS reject_reason FROM items
WHERE rn < 20 AND user_id % 4 = 0 AND user_id NOT IN (SELECT user_id FROM idle)""",
    "refresh_proxies_rejects": """
SELECT 'missing_cell' AS reject_reason, count(DISTINCT (s_nationkey, s_suppkey // 100)) AS n
FROM supplier""",
    "store_round_trip": f"""{FOLLOWS}
SELECT id, slug, CASE WHEN NOT crawl_follow THEN true ELSE crawl_follow END AS crawl_follow
FROM users""",
    "ingest_incremental_queue": f"""{SOURCES}
SELECT source AS slug FROM sources
QUALIFY row_number() OVER (ORDER BY md5(source || '7'), source) > 10""",
    "ingest_articles_rejects": f"""{POSTS}
SELECT DISTINCT resp_seq, 'broken_body' AS reject_reason FROM posts WHERE resp_seq % 5 = 0""",
    "ingest_articles_known_columns": f"""{POSTS}{E1_COLUMNS}
SELECT source AS slug FROM sources WHERE src_no % 4 = 0 UNION SELECT source FROM fresh_columns""",
    "ingest_articles_stored": f"""{POSTS}{E1_COLUMNS}
SELECT (SELECT max(id) FROM stored_articles) + row_number() OVER (ORDER BY md5(md5)) AS id, md5,
       u.id AS author_id, c.id AS belong_id
FROM new_posts JOIN all_users u ON u.no = user_id JOIN all_columns c ON c.slug = source""",
    "append_batches_commits": f"""{ITEMS}
SELECT batch, count(*) AS n_rows, least(100, count(*)) AS most FROM items GROUP BY batch""",
    "stream_dedupe_watermark": f"{ITEMS} SELECT DISTINCT key, slug FROM items",
    "discover_columns": f"""{FOLLOWS}
SELECT row_number() OVER (ORDER BY md5('c' || no)) AS id, 'c' || no AS slug,
       'https://zhuanlan.zhihu.com/c' || no AS link, md5('c' || no) AS hash
FROM (SELECT DISTINCT f.user_id + k AS no FROM follows f JOIN users u USING (user_id)
      WHERE crawl_column = false AND (f.user_id + k) % 4 <> 0)""",
    "discover_random_columns": f"""{SOURCES}
SELECT row_number() OVER (ORDER BY md5(source)) AS id, source AS slug,
       'https://zhuanlan.zhihu.com/' || source AS link, md5(source) AS hash
FROM sources WHERE src_no % 13 <> 5 AND src_no % 4 <> 0""",
    "refresh_proxies": f"""{SUPPLIERS}
, fresh AS (
  SELECT * FROM proxies WHERE status = 200 AND elapsed <= 2
  QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id, pos) = 1)
SELECT id, host, 1 AS port, 2 AS protocol, host IN (SELECT host FROM fresh) AS available FROM stored
UNION ALL
SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY md5(host)), host,
       CAST(port AS INTEGER), code, true
FROM fresh WHERE host NOT IN (SELECT host FROM stored)""",
    "new_articles_per_column": f"""{POSTS}
SELECT source AS column_slug, count(*) FILTER (title IN (SELECT title FROM new_posts)) AS n_new,
       count(*) FILTER (title NOT IN (SELECT title FROM new_posts)) AS n_known
FROM posts GROUP BY source""",
}
for _name in ("explode_contributions", "explode_following_columns"):
    ORACLES[_name] = f"""{WORDS}
SELECT resp_seq, pos, slug, 'https://zhuanlan.zhihu.com/' || slug AS link, md5(slug) AS hash FROM words"""
ORACLES["non_empty_key"] = ORACLES["explode_recommendations"].replace(
    "SELECT resp_seq, pos, slug, 'https://zhuanlan.zhihu.com/' || slug AS link, md5(slug) AS hash\nFROM listed",
    "SELECT resp_seq, pos, slug, md5(slug) AS hash FROM listed WHERE slug <> ''",
)
ORACLES["ingest_articles_feed"] = ORACLES["new_article_feed"]

for _name in "insert_if_absent ingest_articles ingest_single_articles ingest_incremental".split():
    ORACLES[f"{_name}_keyed"] = ORACLES[_name]
ORACLES["ingest_articles_keyed_again"] = f"""
SELECT 1 AS load, count(*) AS n_new FROM ({ORACLES["ingest_articles"]}) UNION ALL SELECT 2, 0"""
ORACLES["assign_ids_reserved"] = f"""{FOLLOWS}
SELECT slug, load,
       (SELECT max(id) FROM stored_users) + row_number() OVER (ORDER BY load, md5(slug)) AS id
FROM (SELECT slug, CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS load FROM users WHERE user_id % 3 <> 0)"""
ORACLES["stream_commits"] = f"""{ITEMS}
, numbered AS (SELECT *, (row_number() OVER (ORDER BY seq) - 1) // 100 AS commit FROM items)
SELECT commit, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n_rows,
       string_agg(key, ',' ORDER BY seq) AS items
FROM numbered GROUP BY commit"""
ORACLES["html_table_rows_nested"] = f"""{SUPPLIERS}
, made AS (
  SELECT *, CASE s_nationkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS pads FROM proxies)
SELECT page_id, pos * (1 + pads) AS pos, host, port, protocol FROM made
UNION ALL
SELECT page_id, CAST(pos * (1 + pads) + j AS INTEGER),
       CASE WHEN s_nationkey % 3 = 0 THEN 'side' ELSE 'in' END,
       CASE WHEN s_nationkey % 3 <> 0 THEN 'side' END, NULL
FROM made, unnest([1, 2, 3]) AS t(j) WHERE j <= pads"""
