"""DuckDB texts of the derived inputs, used as CTEs by the oracle SQL.

They mirror ``framewise.sources.fixtures`` and give identical rows (DuckDB
rounds on ``CAST(double AS INT)`` where Spark truncates, hence ``trunc``;
DuckDB lists are 1-based).
"""

SURVEY = """
SELECT CAST(year(o_orderdate) AS INT) AS REF_DATE, n_name AS GEO,
  CASE WHEN p_size <= 5 THEN 'Ages 6 to 79' WHEN p_size <= 14 THEN 'Ages 6 to 11'
       WHEN p_size <= 23 THEN 'Ages 12 to 19' WHEN p_size <= 32 THEN 'Ages 20 to 39'
       WHEN p_size <= 41 THEN 'Ages 40 to 59' ELSE 'Ages 60 to 79' END AS Age_group,
  CASE WHEN l_linestatus = 'F' THEN 'Females' ELSE 'Males' END AS Sex,
  CASE WHEN l_returnflag = 'R' THEN 'Hearing loss' ELSE 'Other' END AS Categories,
  CASE WHEN l_linenumber % 3 = 0 THEN 'Low 95% confidence interval'
       WHEN l_linenumber % 3 = 1 THEN 'High 95% confidence interval' ELSE 'Estimate' END AS Characteristics,
  CASE WHEN l_quantity = 13 THEN NULL ELSE l_quantity END AS VALUE
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
"""

SL_USERS = """
SELECT n_name AS sha_name, CAST(c_custkey % 7 + 1 AS VARCHAR) AS total_responses,
  CASE WHEN c_custkey % 97 = 0 THEN '' WHEN c_acctbal > 4000 THEN '1' ELSE '0' END AS yes_txt,
  CASE WHEN c_custkey % 97 = 0 THEN '' WHEN c_acctbal > 4000 THEN '0' ELSE '1' END AS no_txt
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

LANDMARKS = """
SELECT vec_id AS frame_id, CASE WHEN pos < 21 THEN 0 ELSE 1 END AS hand_id, CAST(pos AS INT) AS pos,
  CAST(trunc(((vec_id % 5) * 0.2::DOUBLE + 0.1::DOUBLE + 0.2::DOUBLE * embedding[2*pos+1]::DOUBLE) * 640) AS INT) AS x,
  CAST(trunc((0.5::DOUBLE + 0.2::DOUBLE * embedding[2*pos+2]::DOUBLE) * 480) AS INT) AS y
FROM embeddings, range(0, 32) t(pos)
WHERE vec_id % 10 <> 9 AND (pos < 21 OR vec_id % 3 = 0)
"""

FRAMES = """
SELECT vec_id AS frame_id, concat('s', CAST((vec_id // 5) % 4 AS VARCHAR)) AS stream_name,
  make_timestamp(1704067200000000 + vec_id * 200000) AS ts, label,
  list_transform(embedding, lambda e: CAST(trunc(least(greatest((e::DOUBLE + 0.6::DOUBLE) / 1.2::DOUBLE, 0), 1) * 255) AS INT)) AS pixels
FROM embeddings
"""

PICTURES = """
SELECT frame_id, stream_name, ts, label, CASE frame_id % 3 WHEN 0 THEN 8 WHEN 1 THEN 4 ELSE 16 END AS height,
  CASE frame_id % 3 WHEN 0 THEN 8 WHEN 1 THEN 16 ELSE 4 END AS width, pixels,
  list_transform(range(0, 3 * len(pixels)), lambda k: CAST((pixels[k // 3 + 1] * (k % 3 + 1) + k % 3 * 37) % 256 AS INT)) AS bgr
FROM fx_frames
"""

PRED = """
SELECT vec_id AS sample_id, label AS actual,
  CASE WHEN vec_id % 3 = 0 THEN CAST((vec_id * 7 + label) % 10 AS INT) ELSE label END AS predicted
FROM embeddings
"""

IMAGE_NAMES = """
SELECT event_id AS file_id, concat('/data/train/', CASE event_id % 31 WHEN 26 THEN 'del' WHEN 27 THEN 'nothing'
  WHEN 28 THEN 'space' WHEN 29 THEN 'junk' WHEN 30 THEN 'A7' ELSE chr(CAST(65 + event_id % 31 AS INT)) END,
  '_', CAST(event_id AS VARCHAR), '.v1.jpg') AS path
FROM events
"""

LABELS_DIM = """
SELECT CAST(i AS INT) AS label_id, CASE i WHEN 26 THEN 'del' WHEN 27 THEN 'nothing' WHEN 28 THEN 'space' ELSE chr(CAST(65 + i AS INT)) END AS label_name,
  CASE i WHEN 26 THEN 'Del' WHEN 27 THEN 'N' WHEN 28 THEN 'Space' ELSE chr(CAST(65 + i AS INT)) END AS glyph
FROM range(0, 29) t(i)
"""

FIXTURES = {
    "survey": SURVEY, "sl_users": SL_USERS, "landmarks": LANDMARKS, "frames": FRAMES, "pictures": PICTURES,
    "pred": PRED, "image_names": IMAGE_NAMES, "labels_dim": LABELS_DIM,
}


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with ``fx_<name>`` CTEs (merging a leading WITH)."""
    ctes = [f"fx_{n} AS ({FIXTURES[n].strip()})" for n in names]
    text = body.strip()
    if text[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + text[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + text
