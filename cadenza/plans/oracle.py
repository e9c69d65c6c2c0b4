"""DuckDB SQL for the registered queries, written apart from the operators."""

from __future__ import annotations

SEG = """
ev AS (SELECT user_id AS idx, epoch_us(ts) AS us, event_id, event_type, 1000 + CAST(round(value * 1000) AS BIGINT) % 17000 AS dur FROM events),
ev2 AS (SELECT *, coalesce((lead(us) OVER w - us) // 14400000, 0) AS pause, row_number() OVER w - 1 AS i FROM ev WINDOW w AS (PARTITION BY idx ORDER BY us, event_id)),
seg AS (SELECT idx, i, CAST(coalesce(sum(dur + pause) OVER (PARTITION BY idx ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms, dur, event_type <> 'error' AS kept FROM ev2),
segs AS (SELECT idx, i, start_ms, start_ms + dur AS end_ms, kept FROM seg),
gp AS (SELECT idx, i, start_ms, end_ms, end_ms - start_ms AS dur_ms, lead(start_ms) OVER w - end_ms AS gap_ms, coalesce(lead(i) OVER w = i + 1, false) AS next_is_adjacent
       FROM segs WHERE kept WINDOW w AS (PARTITION BY idx ORDER BY i))
"""


def _pack(max_gap: int = 2500, max_dur: int = 29000, pref_max: int | None = 20000, pref_min: int = 5000, good_gap: int = 500, name: str = "grp") -> str:
    """Packing as a recursion over rows whose state is the open group; ``em`` has the groups closed by the row."""
    soft = f"""
      WHEN r.e - cur[1].s <= {pref_max} THEN 'app'
      WHEN cur[len(cur)].e - cur[1].s >= {pref_min} AND cur[len(cur)].g >= {good_gap} THEN 'new'
      WHEN r.e - cur[1].s <= {max_dur} THEN 'app'
      WHEN best IS NOT NULL THEN 'back' ELSE 'new' END""" if pref_max is not None else f" WHEN r.e - cur[1].s <= {max_dur} THEN 'app' ELSE 'new' END"
    return f"""
rows_{name} AS (SELECT idx, row_number() OVER (PARTITION BY idx ORDER BY i) AS rn, {{'i': i, 's': start_ms, 'e': end_ms, 'g': coalesce(gap_ms, 0), 'a': next_is_adjacent}} AS r FROM gp),
st_{name} AS (
  SELECT idx, rn, [r] AS cur, CAST([] AS BIGINT[][]) AS em FROM rows_{name} WHERE rn = 1
  UNION ALL
  SELECT idx, rn,
    CASE act WHEN 'app' THEN list_append(cur, r) WHEN 'back' THEN CASE WHEN r.e - cur[best.j + 1].s <= {max_dur} THEN list_append(cur[best.j + 1:], r) ELSE [r] END ELSE [r] END,
    CASE act WHEN 'app' THEN CAST([] AS BIGINT[][])
      WHEN 'back' THEN CASE WHEN r.e - cur[best.j + 1].s <= {max_dur} THEN [[x.i for x in cur[:best.j]]] ELSE [[x.i for x in cur[:best.j]], [x.i for x in cur[best.j + 1:]]] END
      ELSE [[x.i for x in cur]] END
  FROM (
    SELECT *, CASE WHEN NOT (cur[len(cur)].a AND cur[len(cur)].g <= {max_gap}) THEN 'new' {soft} AS act
    FROM (SELECT b.idx, b.rn, b.r, s.cur, list_max([{{'g': cur[j].g, 'j': j}} for j in range(1, len(cur)) if cur[j].e - cur[1].s >= {pref_min}]) AS best
          FROM st_{name} s JOIN rows_{name} b ON b.idx = s.idx AND b.rn = s.rn + 1)
  )
),
lists_{name} AS (
  SELECT idx, unnest(em) AS g FROM st_{name}
  UNION ALL
  SELECT idx, [x.i for x in cur] FROM (SELECT idx, arg_max(cur, rn) AS cur FROM st_{name} GROUP BY idx)
),
num_{name} AS (SELECT idx, g, row_number() OVER (PARTITION BY idx ORDER BY g[1]) - 1 AS gid FROM lists_{name}),
{name} AS (SELECT idx, gid, CAST(p - 1 AS BIGINT) AS pos, g[p] AS i FROM num_{name}, LATERAL (SELECT unnest(range(1, len(g) + 1)) AS p))
"""


G = f"WITH RECURSIVE {SEG}, {_pack()}"
UTT = """
mem AS (SELECT grp.idx, gid, pos, gp.i, start_ms, end_ms, dur_ms, gap_ms, max(pos) OVER (PARTITION BY grp.idx, gid) AS top FROM grp JOIN gp ON gp.idx = grp.idx AND gp.i = grp.i),
utt AS (SELECT idx, gid, count(*) AS n_segs, min(i) AS first_i, max(i) AS last_i, min(start_ms) AS start_ms, max(end_ms) AS end_ms,
               CAST(sum(dur_ms) + coalesce(sum(CASE WHEN pos < top THEN least(gap_ms, 800) END), 0) - max(pos) * 20 AS BIGINT) AS length_ms FROM mem GROUP BY idx, gid),
exp AS (SELECT * FROM utt WHERE length_ms BETWEEN 2000 AND 30000)
"""
MAN = """
man AS (SELECT 's' || lpad(CAST(idx AS VARCHAR), 3, '0') || '_' || lpad(CAST(row_number() OVER (PARTITION BY idx ORDER BY first_i) AS VARCHAR), 4, '0') AS sid, * FROM {src})
"""
WIN = """
win AS (SELECT vec_id // 10 AS utt, vec_id AS pos, embedding AS e, label AS speaker FROM embeddings),
flat AS (SELECT utt, pos, speaker, k, CAST(e[k] AS DOUBLE) AS x FROM win, LATERAL (SELECT unnest(range(1, len(e) + 1)) AS k))
"""
ROBUST = """
m1 AS (SELECT k, avg(x) AS x FROM flat GROUP BY k), c1 AS (SELECT k, x / sqrt((SELECT sum(x * x) FROM m1)) AS x FROM m1),
s1 AS (SELECT pos, sum(flat.x * c1.x) AS sim FROM flat JOIN c1 USING (k) GROUP BY pos),
m2 AS (SELECT k, avg(x) AS x FROM flat WHERE pos IN (SELECT pos FROM s1 WHERE sim > (SELECT quantile_cont(sim, 0.1) FROM s1)) GROUP BY k),
cen AS (SELECT k, x / sqrt((SELECT sum(x * x) FROM m2)) AS x FROM m2),
sims AS (SELECT utt, pos, round(sum(flat.x * cen.x), 6) AS sim FROM flat JOIN cen USING (k) GROUP BY utt, pos)
"""
HALF = """
ints AS (SELECT utt, CAST(2 * sum(CAST(round(sim * 1000000) AS BIGINT)) + count(*) AS BIGINT) AS a, 2 * count(*) AS b FROM sims GROUP BY utt),
u AS (SELECT utt, CAST((a - ((a % b) + b) % b) // b AS DOUBLE) / 1000000 AS sim FROM ints),
half AS (SELECT utt, sim FROM (SELECT *, row_number() OVER (ORDER BY sim DESC, utt) AS r, count(*) OVER () AS n FROM u) WHERE r <= n // 2)
"""
FR = """
smp AS (SELECT vec_id AS sid, (k - 1) // 4 AS frame, CAST(embedding[k] AS DOUBLE) AS x FROM embeddings, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS k)),
fr AS (SELECT sid, frame, sum(x * x) / 4 AS ms, max(abs(x)) AS peak FROM smp GROUP BY sid, frame)
"""
_DB = "CASE WHEN ms <= 0 THEN -120.0 ELSE 20 * log10(sqrt(ms)) END"
CUT = f"""
{FR},
words AS (SELECT vec_id AS sid, p AS pos, 40 + p * 100 + (vec_id % 3) * 10 AS start_ms, 60 + p * 100 + (vec_id % 3) * 10 AS end_ms FROM embeddings, LATERAL (SELECT unnest(range(0, 3)) AS p)),
gaps AS (
  SELECT sid, 'head' AS kind, CAST(0 AS BIGINT) AS g0, min(start_ms) AS g1 FROM words GROUP BY sid
  UNION ALL SELECT sid, 'tail', max(end_ms), CAST(320 AS BIGINT) FROM words GROUP BY sid
  UNION ALL SELECT sid, 'mid', end_ms, nxt FROM (SELECT sid, end_ms, lead(start_ms) OVER (PARTITION BY sid ORDER BY pos) AS nxt FROM words) WHERE nxt - end_ms > 50),
gw AS (SELECT *, least(g0 // 20, 16) + CASE kind WHEN 'head' THEN 0 ELSE 1 END AS w0, least(g1 // 20, 16) - CASE kind WHEN 'tail' THEN 0 ELSE 1 END AS w1, CAST(16 AS BIGINT) AS nf FROM gaps),
ld AS (SELECT gw.*, frame, lag(frame) OVER (PARTITION BY gw.sid, kind, g0 ORDER BY frame) AS prev FROM gw JOIN fr ON fr.sid = gw.sid AND frame >= w0 AND frame < w1 WHERE {_DB} > -18.5),
isl AS (SELECT *, sum(CASE WHEN prev IS NULL OR (frame - prev > 1 AND frame - prev - 1 >= 2) THEN 1 ELSE 0 END) OVER (PARTITION BY sid, kind, g0 ORDER BY frame) AS island FROM ld),
evt AS (SELECT sid, kind, g0, g1, w0, w1, nf, CAST(min(frame) AS BIGINT) AS first, CAST(max(frame) + 1 AS BIGINT) AS "end" FROM isl GROUP BY sid, kind, g0, g1, w0, w1, nf, island),
ver AS (SELECT sid, kind, g0, g1, first, "end", CASE WHEN first <= w0 AND NOT (kind = 'head' AND w0 = 0) THEN 'no_valley_left' WHEN "end" >= w1 AND NOT (kind = 'tail' AND w1 = nf) THEN 'no_valley_right' ELSE 'cut' END AS verdict FROM evt),
c0 AS (SELECT *, greatest((first - 1) * 20, CASE kind WHEN 'head' THEN 0 ELSE g0 END) AS t0, CASE kind WHEN 'head' THEN ("end" + 1) * 20 WHEN 'tail' THEN least(("end" + 1) * 20, 320) ELSE least(("end" + 1) * 20, g1) END AS t1 FROM ver WHERE verdict = 'cut'),
cuts AS (SELECT sid, kind, CAST(t0 AS BIGINT) AS t0, CAST(t1 AS BIGINT) AS t1, CAST(CASE kind WHEN 'mid' THEN greatest(0, 60 - ((t0 - g0) + (g1 - t1))) ELSE 0 END AS BIGINT) AS pad FROM c0)
"""
ITEMS = r"""
tk AS (SELECT conv_id, turn, string_split(text, ' ') AS t FROM conversations),
ex AS (SELECT conv_id, turn, CAST(p - 1 AS BIGINT) AS pos, t[p] AS token FROM tk, LATERAL (SELECT unnest(range(1, len(t) + 1)) AS p)),
items AS (SELECT conv_id, turn, pos, token, CAST(coalesce(sum(40 * length(token) + (length(token) % 7) * 90) OVER (PARTITION BY conv_id, turn ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms FROM ex),
nx AS (SELECT *, start_ms + 40 * length(token) AS end_ms, lead(start_ms) OVER w AS ns, lead(pos) OVER w AS next_pos, regexp_extract(token, '([^\p{L}\p{N}]*)$', 1) AS between_ FROM items WINDOW w AS (PARTITION BY conv_id, turn ORDER BY pos)),
gaps AS (SELECT conv_id, turn, pos, next_pos, ns - end_ms AS gap_ms, CASE WHEN regexp_matches(between_, '[。！？!?…~～.]') THEN 'fin' WHEN regexp_matches(between_, '[，,、；;：:—]') THEN 'mid' ELSE 'none' END AS kind FROM nx WHERE ns IS NOT NULL),
ends AS (SELECT conv_id, turn, min(start_ms + (conv_id * 37 + turn * 11) % 900) AS head_ms, max(end_ms) + (conv_id * 53) % 1400 - max(end_ms) AS tail_ms FROM nx GROUP BY conv_id, turn),
bnd AS (SELECT quantile_cont(head_ms, 0.75) + 1.5 * (quantile_cont(head_ms, 0.75) - quantile_cont(head_ms, 0.25)) AS head_bound, quantile_cont(tail_ms, 0.75) + 1.5 * (quantile_cont(tail_ms, 0.75) - quantile_cont(tail_ms, 0.25)) AS tail_bound FROM ends)
"""
_LEVELS = """
lv AS (SELECT o_orderkey AS clip, CAST(o_custkey % 20 AS INTEGER) AS episode, -40.0 + (o_totalprice % 2000) / 100 AS loud, -40.0 + (o_totalprice % 2000) / 100 + o_orderkey % 15 AS peak FROM orders),
ep AS (SELECT episode, quantile_cont(loud, 0.5) AS ep FROM lv GROUP BY episode),
tg AS (SELECT quantile_cont(ep, 0.5) AS target FROM ep),
w AS (SELECT clip, episode, loud, peak, {wanted} AS wanted FROM lv JOIN ep USING (episode), tg),
plan AS (SELECT clip, episode, loud, least(wanted, -1.0 - peak) AS gain, least(wanted, -1.0 - peak) < wanted - 1e-9 AS clamped FROM w)
"""
_CLU = f"""
{WIN},
cs AS (SELECT utt // 10 AS idx, speaker AS label, pos, 1000 + pos % 333 AS dur FROM win),
cst AS (SELECT idx, label, sum(dur) AS dur, count(*) AS n FROM cs GROUP BY idx, label),
cm AS (SELECT utt // 10 AS idx, speaker AS label, k, avg(x) AS x FROM flat GROUP BY 1, 2, 3),
cn AS (SELECT idx, label, sqrt(sum(x * x)) AS nrm FROM cm GROUP BY idx, label),
cc AS (SELECT idx, label, k, x / nrm AS x FROM cm JOIN cn USING (idx, label))
"""
_METRICS = "SELECT o_orderkey AS sid, o_totalprice % 97 / 10 AS f0_std, o_custkey % 41 / 3 AS f0_range, o_orderkey % 29 / 7 AS energy_std FROM orders"
_RATES = "SELECT o_orderkey AS sid, o_totalprice % 1000 / 200 + CASE WHEN o_orderkey % 50 = 0 THEN 12.0 ELSE 0.0 END AS cps FROM orders"

SQL: dict[str, str] = {
    "episode_index": "WITH p AS (SELECT DISTINCT printf('src/ep_%05d.wav', user_id) AS path FROM events), n AS (SELECT path, CAST(row_number() OVER (ORDER BY path) - 1 AS VARCHAR) AS r FROM p) SELECT lpad(r, CAST(greatest(length(r), 3) AS INTEGER), '0') AS idx, path FROM n",
    "segment_gaps": f"WITH {SEG} SELECT * FROM gp",
    "vad_coalesce": f"WITH {SEG}, f AS (SELECT *, lag(end_ms) OVER (PARTITION BY idx ORDER BY start_ms) AS pe FROM segs), g AS (SELECT *, sum(CASE WHEN pe IS NULL OR start_ms - pe > 800 THEN 1 ELSE 0 END) OVER (PARTITION BY idx ORDER BY start_ms) AS island FROM f) SELECT idx, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM g GROUP BY idx, island",
    "vad_min_filter": f"WITH {SEG} SELECT idx, i, start_ms, end_ms FROM segs WHERE end_ms - start_ms >= 5000",
    "greedy_groups": f"{G} SELECT * FROM grp",
    "greedy_groups_packed": f"WITH RECURSIVE {SEG}, {_pack(pref_max=None)} SELECT * FROM grp",
    "group_review": f"{G}, m AS (SELECT grp.*, gp.gap_ms, count(*) OVER w AS n, max(end_ms) OVER w - min(start_ms) OVER w AS dur_ms FROM grp JOIN gp USING (idx, i) WINDOW w AS (PARTITION BY grp.idx, gid)) SELECT idx, gid, pos, i, CASE WHEN pos < n - 1 THEN gap_ms END AS gap_after_ms, n, dur_ms FROM m WHERE n > 1",
    "group_validation": f"""WITH RECURSIVE {SEG}, {_pack(6000, 36000, 30000)},
m AS (SELECT idx, gid, pos, i, start_ms, end_ms, gap_ms, next_is_adjacent, lead(i) OVER w AS ni, first_value(start_ms) OVER w AS s0 FROM grp JOIN gp USING (idx, i) WINDOW w AS (PARTITION BY idx, gid ORDER BY pos)),
c AS (SELECT gp.idx, gp.i, count(grp.i) AS times FROM gp LEFT JOIN grp ON grp.idx = gp.idx AND grp.i = gp.i GROUP BY gp.idx, gp.i)
SELECT idx, CAST(NULL AS BIGINT) AS gid, 'cover' AS rule, i FROM c WHERE times <> 1
UNION SELECT idx, gid, 'order', i FROM m WHERE ni <= i
UNION SELECT idx, gid, 'adjacency', i FROM m WHERE ni IS NOT NULL AND NOT next_is_adjacent
UNION SELECT idx, gid, 'gap', i FROM m WHERE ni IS NOT NULL AND next_is_adjacent AND gap_ms > 2500
UNION SELECT idx, gid, 'span', i FROM m WHERE ni IS NULL AND end_ms - s0 > 29000""",
    "split_override": f"""{G}, s AS (SELECT *, count(*) OVER (PARTITION BY idx, gid) AS n FROM grp),
p AS (SELECT idx, gid, i, pos, CASE WHEN n >= 3 THEN 'split1' WHEN n = 2 AND idx % 2 = 0 THEN 'split2' ELSE 'packed' END AS source,
      CASE WHEN n >= 3 THEN CASE WHEN pos = 0 THEN 0 ELSE 1 END WHEN n = 2 AND idx % 2 = 0 THEN pos ELSE 0 END AS part FROM s),
q AS (SELECT *, row_number() OVER (PARTITION BY idx, gid, part ORDER BY pos) - 1 AS np FROM p)
SELECT idx, CAST(sum(CASE WHEN np = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY idx ORDER BY i) - 1 AS BIGINT) AS gid, np AS pos, i, source FROM q""",
    "export_filter": f"{G}, {UTT} SELECT idx, gid, n_segs, length_ms FROM exp",
    "pad_clip": f"""{G}, {UTT}, n AS (SELECT *, lead(start_ms) OVER w AS ns, lag(end_ms) OVER w AS pe FROM exp WINDOW w AS (PARTITION BY idx ORDER BY first_i))
SELECT idx, gid, start_ms, end_ms, greatest(start_ms - 200, CASE WHEN start_ms > pe THEN (start_ms + pe) // 2 END, 0) AS pad_start_ms, least(end_ms + 200, CASE WHEN ns > end_ms THEN (end_ms + ns) // 2 END) AS pad_end_ms FROM n""",
    "manifest": f"{G}, {UTT}, {MAN.format(src='exp')} SELECT sid, idx, gid, n_segs, first_i, last_i, start_ms, end_ms FROM man",
    "export_histogram": f"{G}, {UTT}, b(a, z, bin) AS (VALUES (2, 5, '[2,5)'), (5, 10, '[5,10)'), (10, 15, '[10,15)'), (15, 20, '[15,20)'), (20, 25, '[20,25)'), (25, 30.01, '[25,30.01)')) SELECT bin, count(length_ms) AS n FROM b LEFT JOIN exp ON length_ms >= a * 1000 AND length_ms < z * 1000 GROUP BY bin",
    "export_summary": f"{G}, {UTT} SELECT count(*) AS n, CAST(coalesce(sum(length_ms), 0) AS BIGINT) AS total_ms, min(length_ms) AS min_ms, quantile_cont(length_ms, 0.5) AS median_ms, max(length_ms) AS max_ms FROM exp",
    "episode_stats": f"{G}, {UTT} SELECT idx, count(*) AS groups, count(*) FILTER (length_ms BETWEEN 2000 AND 30000) AS exported, count(*) FILTER (length_ms < 2000) AS too_short, count(*) FILTER (length_ms > 30000) AS too_long FROM utt GROUP BY idx",
    "forced_ends": f"{G}, {UTT} SELECT utt.idx, gid, last_i, coalesce(next_is_adjacent AND gap_ms < 800, false) AS forced FROM utt LEFT JOIN gp ON gp.idx = utt.idx AND gp.i = last_i",
    "cluster_stats": f"WITH {_CLU} SELECT idx, label, CAST(dur AS BIGINT) AS dur, n, CAST(k - 1 AS BIGINT) AS k, round(x, 6) AS x FROM cst JOIN cc USING (idx, label)",
    "target_cluster": f"WITH {_CLU} SELECT idx, label FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY dur DESC, label) AS r FROM cst) WHERE r = 1",
    "target_cluster_ref": f"""WITH {_CLU}, r0 AS (SELECT k, x FROM flat WHERE pos = 0), r AS (SELECT k, x / sqrt((SELECT sum(x * x) FROM r0)) AS x FROM r0),
d AS (SELECT idx, label, 1 - sum(cc.x * r.x) AS dist FROM cc JOIN r USING (k) GROUP BY idx, label)
SELECT idx, CASE WHEN dist <= 0.75 THEN label END AS label, round(dist, 6) AS ref_dist FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY dist, label) AS n FROM d) WHERE n = 1""",
    "robust_centroid": f"WITH {WIN}, {ROBUST} SELECT CAST(k - 1 AS BIGINT) AS k, round(x, 6) AS x FROM cen",
    "window_similarity": f"WITH {WIN}, {ROBUST} SELECT utt, pos, sim FROM sims",
    "upper_half": f"WITH {WIN}, {ROBUST}, {HALF} SELECT utt, sim FROM half",
    "second_centroid": f"""WITH {WIN}, {ROBUST}, {HALF}, m3 AS (SELECT k, avg(x) AS x FROM flat WHERE utt IN (SELECT utt FROM half) GROUP BY k)
SELECT CAST(k - 1 AS BIGINT) AS k, round(x / sqrt((SELECT sum(x * x) FROM m3)), 6) AS x FROM m3""",
    "manifest_check": f"""{G}, {UTT}, {MAN.format(src='exp')}, w AS (SELECT sid, idx, gid, CASE WHEN gid % 11 = 4 OR (gid % 5 = 2 AND n_segs = 1) THEN 'no_group' WHEN gid % 5 = 2 THEN 'size' WHEN gid % 7 = 3 THEN 'members' END AS why FROM man)
SELECT * FROM w WHERE why IS NOT NULL""",
    "kept_results": "SELECT doc_id, CAST(CASE WHEN doc_id % 2 = 0 THEN toxic + 10 ELSE quality END AS BIGINT) AS verdict FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 6 = 0)",
    "changed_samples": "SELECT doc_id, sha1(text) AS old_sha, sha1(text || '!') AS new_sha FROM documents WHERE doc_id % 10 = 7 ORDER BY doc_id LIMIT 12",
    "episode_subset": f"WITH {SEG} SELECT idx, i, start_ms FROM segs WHERE idx % 4 = 1",
    "with_audio": "SELECT doc_id AS sid FROM documents WHERE doc_id IN (SELECT vec_id * 3 FROM embeddings)",
    "enhancement_summary": """WITH e AS (SELECT o_custkey % 100 / 100 AS sim, CAST(o_orderkey % 37 AS DOUBLE) AS g FROM orders)
SELECT count(*) FILTER (sim >= 0.9) AS n_ok, count(*) FILTER (sim < 0.9) AS n_low, quantile_cont(sim, 0.5) AS sim_median, quantile_cont(g, 0.5) AS floor_gain_median FROM e""",
    "speaker_purity": f"""WITH {WIN}, {ROBUST}, l AS (SELECT *, sim < 0.05 AS low, row_number() OVER (PARTITION BY utt ORDER BY pos) - row_number() OVER (PARTITION BY utt, sim < 0.05 ORDER BY pos) AS isl FROM sims),
r AS (SELECT utt, low, isl, count(*) AS run FROM l GROUP BY utt, low, isl), t AS (SELECT utt, max(CASE WHEN low THEN run ELSE 0 END) AS longest FROM r GROUP BY utt),
a AS (SELECT utt, count(*) AS n, min(sim) AS min_sim, round(sum(sim) / count(*), 7) AS mean_sim FROM sims GROUP BY utt)
SELECT utt, n, min_sim, mean_sim, longest, longest >= 2 AS flagged, longest >= 2 AND (longest >= 4 OR min_sim <= -0.2) AS severe FROM a JOIN t USING (utt)""",
    "frame_levels": f"WITH {FR} SELECT sid, frame, round(20 * log10(sqrt(ms) + 1e-10), 6) AS db_export, round({_DB}, 6) AS db_frame, round(20 * log10(sqrt(ms + 1e-12)), 6) AS db_prosody, round(20 * log10(sqrt(ms) + 1e-12), 6) AS db_loudness FROM fr",
    "noise_floor": f"WITH {FR}, d AS (SELECT sid, frame, round({_DB}, 6) AS db FROM fr), r AS (SELECT *, count(*) OVER (PARTITION BY sid) AS n, row_number() OVER (PARTITION BY sid ORDER BY db, frame) AS r FROM d) SELECT sid, n, round(CASE WHEN n < 5 THEN -120.0 ELSE avg(db) FILTER (r <= greatest(1, n // 5)) END, 6) AS floor_db FROM r GROUP BY sid, n",
    "active_level": f"""WITH {FR}, d AS (SELECT sid, round(20 * log10(sqrt(ms) + 1e-12), 6) AS db, peak FROM fr), n AS (SELECT sid, quantile_cont(db, 0.05) AS noise, quantile_cont(db, 0.5) AS alld, max(peak) AS peak FROM d GROUP BY sid),
v AS (SELECT sid, quantile_cont(db, 0.5) AS voiced FROM d JOIN n USING (sid) WHERE db > noise + 5 GROUP BY sid)
SELECT sid, round(noise, 8) AS noise_db, round(coalesce(voiced, alld), 8) AS active_db, round(20 * log10(peak + 1e-12), 8) AS peak_db FROM n LEFT JOIN v USING (sid)""",
    "frame_events": f"""WITH {FR}, l AS (SELECT sid, frame, lag(frame) OVER (PARTITION BY sid ORDER BY frame) AS prev FROM fr WHERE {_DB} > -18.0),
i AS (SELECT *, sum(CASE WHEN prev IS NULL OR (frame - prev > 1 AND frame - prev - 1 >= 2) THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY frame) AS isl FROM l)
SELECT sid, min(frame) AS first, max(frame) + 1 AS "end" FROM i GROUP BY sid, isl HAVING max(frame) + 1 - min(frame) >= 2""",
    "gap_event_plan": f"WITH {CUT} SELECT * FROM ver",
    "cut_plan": f"WITH {CUT} SELECT * FROM cuts",
    "item_shift": f"WITH {CUT} SELECT w.sid, w.pos, CAST(start_ms - coalesce(sum(CASE WHEN t1 <= start_ms THEN t1 - t0 - pad END), 0) AS BIGINT) AS start_ms, CAST(end_ms - coalesce(sum(CASE WHEN t1 <= end_ms THEN t1 - t0 - pad END), 0) AS BIGINT) AS end_ms FROM words w LEFT JOIN cuts c ON c.sid = w.sid GROUP BY w.sid, w.pos, start_ms, end_ms",
    "cut_totals": f"WITH {CUT} SELECT kind, count(*) AS n, CAST(sum(t1 - t0) AS BIGINT) AS cut_ms, CAST(sum(pad) AS BIGINT) AS pad_ms, count(DISTINCT sid) AS clips FROM cuts GROUP BY kind",
    "overlapping_levels": """WITH s AS (SELECT vec_id AS sid, unnest(range(0, len(embedding))) AS k, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
n AS (SELECT vec_id AS sid, unnest(range(0, (len(embedding) - 10) // 4)) AS frame FROM embeddings)
SELECT n.sid, n.frame, round(20 * log10(sqrt(sum(x * x) / 10) + 1e-12), 6) AS db FROM n JOIN s ON s.sid = n.sid AND s.k >= 4 * n.frame AND s.k < 4 * n.frame + 10 GROUP BY n.sid, n.frame""",
    "audible_windows": """WITH s AS (SELECT vec_id AS sid, unnest(range(0, len(embedding))) AS k, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
w AS (SELECT vec_id AS sid, len(embedding) AS n, unnest(range(0, greatest(1, len(embedding) - 10), 6)) AS a FROM embeddings),
r AS (SELECT w.sid, w.a // 6 AS pos, w.a, least(w.a + 20, w.n) AS b, sqrt(sum(x * x) / (least(w.a + 20, w.n) - w.a)) AS rms FROM w JOIN s ON s.sid = w.sid AND s.k >= w.a AND s.k < w.a + 20 GROUP BY w.sid, w.a, w.n)
SELECT sid, pos, a, b, round(rms, 6) AS rms FROM r WHERE 2 * (b - a) >= 20 AND rms > 0.11""",
    "aligned_words": r"""WITH RECURSIVE ex AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word, unnest(range(0, len(string_split(text, ' ')))) AS pos FROM conversations),
tm AS (SELECT *, CAST(coalesce(sum(40 * length(word) + (length(word) % 7) * 90) OVER (PARTITION BY conv_id, turn ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms FROM ex),
hd AS (SELECT conv_id, turn, pos, CASE WHEN pos = 41 AND conv_id % 3 = 0 THEN '#' ELSE regexp_replace(word, '[^\p{L}\p{N}]', '', 'g') END AS token, start_ms, start_ms + 40 * length(word) AS end_ms FROM tm
       WHERE pos % 7 <> 6 AND regexp_replace(word, '[^\p{L}\p{N}]', '', 'g') <> ''),
it AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY pos) AS k FROM hd),
walk AS (SELECT conv_id, turn, CAST(0 AS BIGINT) AS k, text AS rest, CAST(-1 AS BIGINT) AS step, '' AS before FROM conversations
         UNION ALL
         SELECT w.conv_id, w.turn, it.k, substr(w.rest, strpos(w.rest, it.token) + length(it.token)), w.step + strpos(w.rest, it.token), substr(w.rest, 1, strpos(w.rest, it.token) - 1)
         FROM walk w JOIN it ON it.conv_id = w.conv_id AND it.turn = w.turn AND it.k = w.k + 1 WHERE strpos(w.rest, it.token) > 0),
met AS (SELECT *, coalesce(lead(before) OVER (PARTITION BY conv_id, turn ORDER BY k), rest) AS between_ FROM walk)
SELECT conv_id || '-' || turn AS sid, step AS pos, token, start_ms, end_ms,
       CASE WHEN regexp_matches(between_, '[。！？!?…~～.]') THEN 'fin' WHEN regexp_matches(between_, '[，,、；;：:—]') THEN 'mid' ELSE 'none' END AS kind
FROM met JOIN it USING (conv_id, turn, k)""",
    "metadata_parse": "WITH l AS (SELECT CAST(doc_id AS VARCHAR) || '|' || replace(text, chr(10), ' ') AS line FROM documents) SELECT substr(line, 1, strpos(line, '|') - 1) AS sid, substr(line, strpos(line, '|') + 1) AS text FROM l",
    "filelist_format": "SELECT 'wavs/' || CAST(doc_id AS VARCHAR) || '.wav|speaker|ZH|' || regexp_replace(replace(text, chr(10), ' '), '[\\r\\n]+', ' ', 'g') AS line FROM documents",
    "char_metrics": """WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents UNION ALL VALUES ('v1', '你好，world 3。'), ('v2', '㐀一鿿!'), ('v3', '…？'), ('v4', '')),
s AS (SELECT id, text, regexp_replace(text, '[^一-鿿㐀-䶿A-Za-z0-9]', '', 'g') AS k FROM t)
SELECT id, regexp_matches(text, '[一-鿿]') AS chinese, sha256(k) AS stripped_sha, length(k) AS n_stripped, length(regexp_replace(text, '[^一-鿿A-Za-z0-9]', '', 'g')) AS n_chars FROM s""",
    "transcript_filter": "WITH t AS (SELECT CASE WHEN turn % 2 = 0 THEN '你' || text ELSE text END AS x FROM conversations), k AS (SELECT coalesce(length(x) >= 2 AND regexp_matches(x, '[一-鿿]'), false) AS ok FROM t) SELECT ok AS kept, NOT ok AS dropped_asr, count(*) AS n FROM k GROUP BY ok",
    "join_texts": """WITH RECURSIVE t AS (SELECT conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS x FROM conversations), k AS (SELECT conv_id, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM t WHERE x <> ''),
j AS (SELECT conv_id, r, x AS s FROM k WHERE r = 1 UNION ALL SELECT j.conv_id, k.r, s || CASE WHEN contains('。！？；：、，!?;:,~—…', right(s, 1)) THEN '' ELSE ',' END || k.x FROM j JOIN k ON k.conv_id = j.conv_id AND k.r = j.r + 1)
SELECT c.conv_id, sha256(coalesce(arg_max(s, r), '')) AS joined_sha FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN j USING (conv_id) GROUP BY c.conv_id""",
    "token_gaps": f"WITH {ITEMS} SELECT * FROM gaps",
    "silence_bounds": f"WITH {ITEMS} SELECT round(head_bound, 6) AS head_bound, round(tail_bound, 6) AS tail_bound FROM bnd",
    "silence_flags": f"""WITH {ITEMS}
SELECT conv_id, turn, printf('head=%.2fs>%.2f', head_ms / 1000.0, head_bound / 1000.0) AS reason FROM ends, bnd WHERE head_ms > head_bound
UNION ALL SELECT conv_id, turn, printf('tail=%.2fs>%.2f', tail_ms / 1000.0, tail_bound / 1000.0) FROM ends, bnd WHERE tail_ms > tail_bound
UNION ALL SELECT conv_id, turn, printf('%s_gap=%.2fs@%d-%d', kind, gap_ms / 1000.0, pos, next_pos) FROM gaps WHERE gap_ms >= 450 AND kind IN ('mid', 'fin')""",
    "silence_distribution": f"""WITH {ITEMS}, a AS (SELECT kind, gap_ms AS ms FROM gaps UNION ALL SELECT 'head', head_ms FROM ends UNION ALL SELECT 'tail', tail_ms FROM ends), k(kind) AS (VALUES ('head'), ('tail'), ('mid'), ('fin'), ('none'))
SELECT k.kind, count(ms) AS n, round(avg(ms), 6) AS mean, round(quantile_cont(ms, 0.5), 6) AS median, round(quantile_cont(ms, 0.9), 6) AS p90, max(ms) AS max FROM k LEFT JOIN a USING (kind) GROUP BY k.kind""",
    "tail_mark_rewrite": f"""{G}, {UTT}, {MAN.format(src='utt')}, f AS (SELECT sid, last_i, coalesce(next_is_adjacent AND gap_ms < 800, false) AS forced FROM man LEFT JOIN gp ON gp.idx = man.idx AND gp.i = man.last_i)
SELECT sid, CASE WHEN forced AND last_i % 3 < 2 THEN '好,' ELSE CASE last_i % 3 WHEN 0 THEN '好。 ' WHEN 1 THEN '好。' ELSE '好！' END END AS text, forced AND last_i % 3 < 2 AS changed FROM f""",
    "prosody_score": f"""WITH m AS ({_METRICS}), s AS (SELECT avg(f0_std) a, stddev_pop(f0_std) + 1e-9 b, avg(f0_range) c, stddev_pop(f0_range) + 1e-9 d, avg(energy_std) e, stddev_pop(energy_std) + 1e-9 f FROM m),
z AS (SELECT sid, ((f0_std - a) / b + (f0_range - c) / d + (energy_std - e) / f) / 3 AS z FROM m, s), q AS (SELECT quantile_cont(z, [0.2, 0.4, 0.6, 0.8]) AS q FROM z)
SELECT sid, round(z, 6) AS prosody_score, CAST(1 + (z > q[1])::INT + (z > q[2])::INT + (z > q[3])::INT + (z > q[4])::INT AS INTEGER) AS prosody_level FROM z, q""",
    "rate_outliers": f"WITH r AS ({_RATES}), b AS (SELECT quantile_cont(cps, 0.75) + 1.5 * (quantile_cont(cps, 0.75) - quantile_cont(cps, 0.25)) AS bound FROM r) SELECT sid, round(cps, 6) AS cps, round(bound, 6) AS bound FROM r, b WHERE cps > bound",
    "loudness_plan": f"WITH {_LEVELS.format(wanted='target - ep')} SELECT clip, episode, round(gain, 6) AS gain, clamped, abs(gain) < 0.01 AS noop FROM plan",
    "loudness_plan_ratio": f"WITH {_LEVELS.format(wanted='target - loud + (loud - ep) * 0.3')} SELECT clip, episode, round(gain, 6) AS gain, clamped, abs(gain) < 0.01 AS noop FROM plan",
    "loudness_episodes": f"WITH {_LEVELS.format(wanted='target - ep')} SELECT episode, count(*) AS n_utts, count(*) FILTER (clamped) AS n_clamped, round(quantile_cont(loud, 0.5), 6) AS measured, round(quantile_cont(gain, 0.5), 6) AS gain, round(quantile_cont(loud + gain, 0.5), 6) AS achieved FROM plan GROUP BY episode",
    "removal_antijoin": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 OR toxic = 1)",
    "resume_todo": "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "fingerprint": "SELECT doc_id // 1000 AS part, substr(sha1(string_agg(CAST(doc_id AS VARCHAR) || ':' || sha1(text), '|' ORDER BY CAST(doc_id AS VARCHAR) || ':' || sha1(text))), 1, 16) AS fp FROM documents GROUP BY 1",
    "freshness_check": "WITH d AS (SELECT doc_id AS sid, length(text) AS frames FROM documents), w AS (SELECT sid, frames, CASE WHEN sid % 11 = 3 THEN NULL WHEN sid % 7 = 2 THEN frames + 1 ELSE frames END AS was FROM d) SELECT sid, frames, was, CASE WHEN was IS NULL THEN 'new' ELSE 'changed' END AS why FROM w WHERE was IS NULL OR was <> frames",
    "audit_summary": "WITH e AS (SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events) SELECT CASE WHEN event_type = 'error' THEN 'error' WHEN k < 10 THEN 'drop' WHEN k < 30 THEN 'review' ELSE 'keep' END AS verdict, count(*) AS n, count(*) FILTER (k % 2 = 0) AS noisy, count(*) FILTER (k % 3 = 0) AS clipped FROM e GROUP BY 1",
    "separation_guard": f"""WITH {FR}, f AS (SELECT sid, avg(ms) AS a, avg(ms) FILTER (frame < 4) * CASE sid % 5 WHEN 0 THEN 1e-6 WHEN 1 THEN 1e-2 ELSE 1.0 END AS b FROM fr GROUP BY sid),
l AS (SELECT sid, round({_DB.replace('ms', 'a')}, 6) AS full_db, round({_DB.replace('ms', 'b')}, 6) AS vocals_db FROM f)
SELECT sid, full_db, vocals_db, full_db > -40 AND vocals_db < -60 AS silent, vocals_db > -45 AND vocals_db >= full_db - 15 AS passed FROM l""",
}
