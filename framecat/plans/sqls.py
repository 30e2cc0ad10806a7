"""SQL pieces that several checking queries share."""

from __future__ import annotations

from framecat.plans import base, views
from framecat.schemas import FINGERPRINT_DIM, METADATA_DIM

#: Two position-weighted sums over a list of doubles v, rounded.
CHECKSUMS = """round(list_inner_product(v, range(1, len(v) + 1)::double[]), 6) + 0.0::double AS weighted,
      round(list_inner_product(list_transform(v, lambda x: x * x), range(1, len(v) + 1)::double[]), 6) + 0.0::double AS weighted_square"""


def word(hex_text: str, j: str) -> str:
    return f"cast('0x' || substr({hex_text}, 1 + 8 * ({j}), 8) AS ubigint)::double / 4294967296"


FEATURES = """[channel_count / 64.0::double, part_count / 16.0::double, is_deep::int::double,
  is_tiled::int::double, has_multiview::int::double,
  CASE codec WHEN 'none' THEN 0.0 WHEN 'rle' THEN 0.2 WHEN 'zips' THEN 0.4 WHEN 'zip' THEN 0.5
  WHEN 'piz' THEN 0.6 WHEN 'pxr24' THEN 0.7 WHEN 'b44' THEN 0.8 WHEN 'b44a' THEN 0.85
  WHEN 'dwaa' THEN 0.9 WHEN 'dwab' THEN 0.95 ELSE 0.5 END::double]"""


FINGERPRINTS = f"""{views.sql_views("files", "parts", "channels")}, c AS (
  SELECT file_key, count(*)::double AS n,
         count(DISTINCT CASE WHEN contains(channel_name, '.') THEN split_part(channel_name, '.', 1) END) AS roots,
         sum(x_sampling) AS xs, sum(y_sampling) AS ys,
         count(*) FILTER (lower(channel_type) = 'float') AS floats,
         count(*) FILTER (lower(channel_type) = 'half') AS halves,
         md5(string_agg(channel_name, '|' ORDER BY part_index, channel_name)) AS h
  FROM fx_channels GROUP BY file_key),
head AS (
  SELECT file_key, [n / 64, roots / n, xs / (n * 2), ys / (n * 2), floats / n, halves / n, 0.0::double, 0.0::double,
         {word("h", "0")}, {word("h", "1")}, {word("h", "2")}] AS f FROM c),
padded AS (
  SELECT file_key, list_concat(f, list_transform(range(11, {FINGERPRINT_DIM}),
         lambda i: abs((f[1] + f[2] + f[3] + f[4]) * (i + 1)) % 1.0::double)) AS p FROM head),
unit AS (
  SELECT file_key, list_transform(p, lambda x: x / sqrt(list_inner_product(p, p))) AS v FROM padded),
filled AS (
  SELECT file_key, coalesce(v, list_transform(range({FINGERPRINT_DIM}), lambda i: 0.0::double)) AS v
  FROM fx_files LEFT JOIN unit USING (file_key))"""

def embedded(weight: float) -> str:
    """WITH clause giving ``unit``: file_key and embedding v."""
    return f"""{base.structure_views()}, tail AS (
  SELECT file_key, list(w ORDER BY i, j) AS w FROM (
    SELECT file_key, i, j, {weight}::double * ({word("h", "j")}) AS w
    FROM (SELECT file_key, i, sha256(structure_digest || '#' || i) AS h
          FROM fx_structures CROSS JOIN range(48) AS r(i)) CROSS JOIN range(8) AS s(j))
  GROUP BY file_key),
padded AS (
  SELECT file_key, list_concat({FEATURES}, w)[1:{METADATA_DIM}] AS p
  FROM fx_structures JOIN tail USING (file_key)),
unit AS (
  SELECT file_key, list_transform(p, lambda x: x / sqrt(list_inner_product(p, p))) AS v FROM padded)"""


