"""DuckDB fragments giving the driver tables the same input schemas as
``quiver.sources.tables`` (renames only), for the oracle queries."""

RAW_PLAYLISTS = """
raw_playlists AS (
  SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS user_id,
         CAST(CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 10 AS VARCHAR) AS artist,
         regexp_extract(props, '[0-9]+') AS track, event_type AS playlist
  FROM events)"""

PLAYLISTS = RAW_PLAYLISTS + """,
playlists AS (
  SELECT *, concat(user_id, '-', playlist) AS playlist_id,
         concat(artist, '|||', track) AS track_id
  FROM raw_playlists)"""

SEQUENCES = PLAYLISTS + """,
seqs AS (
  SELECT playlist_id,
         list(artist ORDER BY row_id) AS artist_sequence,
         list(track_id ORDER BY row_id) AS track_sequence
  FROM playlists GROUP BY playlist_id
  HAVING len(list(track_id ORDER BY row_id)) > 2)"""

RAW_ARTICLES = """
raw_articles AS (
  SELECT p_partkey AS article_id, p_size AS product_code,
         CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS product_type_no,
         p_type AS product_group_name, p_size % 10 AS graphical_appearance_no,
         p_size % 7 AS colour_group_code, p_size % 5 AS perceived_colour_value_id,
         p_size % 3 AS perceived_colour_master_id,
         CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) % 10 AS department_no,
         p_brand AS index_code,
         CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) % 4 AS index_group_no,
         p_size % 11 AS section_no, p_size % 13 AS garment_group_no
  FROM part)"""

STAGED_ARTICLES = RAW_ARTICLES + """,
articles AS (
  SELECT article_id::INT AS article_id, product_code::INT AS product_code,
         product_type_no::INT AS product_type_no, product_group_name::VARCHAR AS product_group_name,
         graphical_appearance_no::INT AS graphical_appearance_no,
         colour_group_code::INT AS colour_group_code,
         perceived_colour_value_id::INT AS perceived_colour_value_id,
         perceived_colour_master_id::INT AS perceived_colour_master_id,
         department_no::INT AS department_no, index_code::VARCHAR AS index_code,
         index_group_no::INT AS index_group_no, section_no::INT AS section_no,
         garment_group_no::INT AS garment_group_no
  FROM raw_articles)"""

RAW_CUSTOMERS = """
raw_customers AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS Active, c_mktsegment AS FN,
         CAST(c_acctbal / 100 AS VARCHAR) AS age, c_mktsegment AS club_member_status,
         CAST(c_custkey AS VARCHAR) AS customer_id,
         CAST(c_nationkey % 3 AS VARCHAR) AS fashion_news_frequency,
         CAST(c_nationkey AS VARCHAR) AS postal_code
  FROM customer)"""

STAGED_CUSTOMERS = RAW_CUSTOMERS + """,
customers AS (
  SELECT COALESCE(TRY_CAST(Active AS DOUBLE), 0.0) AS active,
         COALESCE(TRY_CAST(FN AS DOUBLE), 0.0) AS fn,
         COALESCE(TRY_CAST(age AS DOUBLE), 0.0) AS age,
         club_member_status::VARCHAR AS club_member_status,
         customer_id::VARCHAR AS customer_id,
         fashion_news_frequency::VARCHAR AS fashion_news_frequency,
         postal_code::VARCHAR AS postal_code
  FROM raw_customers)"""

RAW_TX = """
raw_tx AS (
  SELECT l_partkey AS article_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         l_extendedprice AS price, l_linenumber AS sales_channel_id, l_shipdate AS t_dat,
         l_orderkey AS tie_order, l_suppkey AS tie_supp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

STAGED_TX = RAW_TX + """,
tx AS (
  SELECT article_id::INT AS article_id, customer_id::VARCHAR AS customer_id,
         price::FLOAT AS price, sales_channel_id::INT AS sales_channel_id,
         t_dat::TIMESTAMP AS t_dat, tie_order, tie_supp
  FROM raw_tx)"""

DEDUP = STAGED_TX + """,
dd AS (SELECT DISTINCT article_id, customer_id, price, sales_channel_id, t_dat FROM tx),
dedup AS (
  SELECT article_id, customer_id,
         last_value(price) OVER w AS price,
         last_value(sales_channel_id) OVER w AS sales_channel_id,
         t_dat
  FROM dd
  WINDOW w AS (PARTITION BY article_id, customer_id, t_dat ORDER BY price, sales_channel_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""

JOINED = DEDUP + "," + STAGED_ARTICLES.lstrip() + "," + STAGED_CUSTOMERS.lstrip() + """,
joined AS (
  SELECT a.*, c.*, t.price, t.sales_channel_id, t.t_dat
  FROM dedup t JOIN articles a ON a.article_id = t.article_id
  JOIN customers c ON c.customer_id = t.customer_id)"""

FILTERED = JOINED + """,
freq AS (
  SELECT customer_id, COUNT(*) AS user_interactions FROM joined
  WHERE t_dat < TIMESTAMP '2001-01-01' GROUP BY customer_id HAVING COUNT(*) >= 5),
filtered AS (SELECT j.* FROM joined j SEMI JOIN freq f ON j.customer_id = f.customer_id)"""

SPLIT = FILTERED + """,
split_rows AS (
  SELECT *, CASE WHEN t_dat < TIMESTAMP '2001-01-01' THEN 'train'
                 WHEN t_dat < TIMESTAMP '2001-07-01' THEN 'valid'
                 WHEN t_dat >= TIMESTAMP '2001-07-01' THEN 'test' END AS split
  FROM filtered)"""

REVIEWS = """
reviews AS (
  SELECT d.doc_id, d.text AS review, l.quality AS labels, d.n_chars AS score_raw,
         d.n_chars / (d.n_chars + 2000.0::DOUBLE) AS score, d.lang
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

VECTORS = """
vectors AS (
  SELECT concat(CAST(vec_id % 10 AS VARCHAR), '|||', CAST(vec_id AS VARCHAR)) AS item_id,
         CAST(embedding AS DOUBLE[]) AS vec, label
  FROM embeddings)"""

IMAGES = """
images AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS image_key, CAST(o_orderkey AS VARCHAR) || '.jpg' AS name,
         o_orderpriority AS target, CAST(o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o_orderstatus = 'F' THEN 'right' ELSE 'left' END AS leading_hand
  FROM orders)"""

BOXES = """
boxes AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS image_key, l_linenumber AS box_pos,
         l_discount AS x, l_tax AS y, l_quantity / 100 AS w, (l_discount + l_tax) / 2 AS h,
         CASE WHEN l_returnflag = 'N' THEN 'no_gesture' WHEN l_returnflag = 'A' THEN 'call'
              ELSE 'rock' END AS label,
         l_discount * 10 AS score
  FROM lineitem)"""

FILES = """
files AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '.jpg' AS name FROM lineitem)"""

RUNS = """
runs AS (
  SELECT user_id AS flow, event_id AS run_id, event_type <> 'error' AS successful,
         [event_type] AS tags, value AS metric, ts AS created_at
  FROM events)"""


RUN_RECORDS = """
run_records AS (SELECT o_orderkey AS run_id, o_custkey AS flow, o_orderstatus = 'F' AS successful,
                       o_orderdate AS created_at FROM orders)"""

RUN_RESULTS = """
run_results AS (SELECT l_orderkey AS run_id, l_linenumber AS row_idx, l_returnflag AS model,
                       l_quantity / 50 AS accuracy, l_tax * 10 AS test_loss FROM lineitem)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts)
