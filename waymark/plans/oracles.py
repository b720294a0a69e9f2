"""DuckDB SQL for the registered queries of the capture operators."""

from waymark.plans import round_trips, pictures, streams
from waymark.plans.fixtures import FRAMES_SQL, GAUSSIANS_SQL

_MEMBERS = f"""{FRAMES_SQL},
fx_own as (select *, cast(floor(x / 20.0e0) as int) as ox, cast(floor(y / 20.0e0) as int) as oy from fx_frames),
fx_earned as (select ox as cx, oy as cy from fx_own group by 1, 2 having count(*) >= 5),
fx_dx as (select distinct seq, cast(floor((x + d) / 20.0e0) as int) as cx from fx_own, (values (-4.0e0), (0.0e0), (4.0e0)) v(d)),
fx_dy as (select distinct seq, cast(floor((y + d) / 20.0e0) as int) as cy from fx_own, (values (-4.0e0), (0.0e0), (4.0e0)) v(d)),
fx_members as (
  select 'chunk_x' || cx || '_y' || cy as chunk, cx, cy, o.seq, o.video, o.t, o.x, o.y, o.z, cx = ox and cy = oy as is_core
  from fx_own o join fx_dx using (seq) join fx_dy using (seq) join fx_earned using (cx, cy)
)"""

_MANIFEST = f"""{_MEMBERS},
fx_manifest as (
  select chunk, cx, cy, count(*) as frames, count(*) filter (is_core) as core_frames, array_to_string(list_sort(list(distinct video)), ',') as passes,
    round(avg(x) + 1e-7, 3) as centre_x, round(avg(y) + 1e-7, 3) as centre_y, cx * 20.0e0 as x0, cy * 20.0e0 as y0, (cx + 1) * 20.0e0 as x1, (cy + 1) * 20.0e0 as y1
  from fx_members group by chunk, cx, cy
)"""

_PASSES = f"""{FRAMES_SQL},
fx_cut as (
  select *, case when lag(seq) over w is not null and (coalesce(sqrt(pow(x - lag(x) over w, 2) + pow(y - lag(y) over w, 2)) > 1.5, false) or coalesce(abs(t - lag(t) over w) > 30, false)) then 1 else 0 end as cut
  from fx_frames window w as (partition by video order by seq)
),
fx_passes as (select *, cast(sum(cut) over (partition by video order by seq rows between unbounded preceding and current row) as int) as pass from fx_cut)"""

_CORRIDOR = f"""{_PASSES},
fx_n as (select *, row_number() over (partition by video, pass order by seq) as i, count(*) over (partition by video, pass) as n from fx_passes),
fx_fold(video, pass, seq, x, y, z, i, n, kx, ky, kept) as (
  select video, pass, seq, x, y, z, i, n, x, y, true from fx_n where i = 1
  union all
  select r.video, r.pass, r.seq, r.x, r.y, r.z, r.i, r.n,
    case when sqrt(pow(r.x - f.kx, 2) + pow(r.y - f.ky, 2)) >= 1.0 then r.x else f.kx end, case when sqrt(pow(r.x - f.kx, 2) + pow(r.y - f.ky, 2)) >= 1.0 then r.y else f.ky end,
    sqrt(pow(r.x - f.kx, 2) + pow(r.y - f.ky, 2)) >= 1.0
  from fx_fold f join fx_n r on r.video = f.video and r.pass = f.pass and r.i = f.i + 1
),
fx_corridor as (select video, pass, seq, round(x, 3) as x, round(y, 3) as y, round(z, 3) as z from fx_fold where n >= 2 and (kept or i = n or n < 3))"""

_TRACKS = f"""{_MEMBERS},
fx_points as (select chunk, seq, video, t, x, y, z + ((cx * 7 + cy * 13) % 5) * 0.9e0 as z from fx_members),
fx_tcut as (
  select *, case when lag(seq) over w is not null and (coalesce(sqrt(pow(x - lag(x) over w, 2) + pow(y - lag(y) over w, 2)) > 30, false) or video <> lag(video) over w or coalesce(abs(t - lag(t) over w) > 30, false)) then 1 else 0 end as cut
  from fx_points window w as (partition by chunk order by seq)
),
fx_tpass as (select *, cast(sum(cut) over (partition by chunk order by seq rows between unbounded preceding and current row) as int) as pass from fx_tcut),
fx_tn as (select *, row_number() over (partition by chunk, pass order by seq) as i, count(*) over (partition by chunk, pass) as n from fx_tpass),
fx_tfold(chunk, pass, seq, x, y, z, i, n, kx, ky, kept) as (
  select chunk, pass, seq, x, y, z, i, n, x, y, true from fx_tn where i = 1
  union all
  select r.chunk, r.pass, r.seq, r.x, r.y, r.z, r.i, r.n,
    case when sqrt(pow(r.x - f.kx, 2) + pow(r.y - f.ky, 2)) >= 5.0 then r.x else f.kx end, case when sqrt(pow(r.x - f.kx, 2) + pow(r.y - f.ky, 2)) >= 5.0 then r.y else f.ky end,
    sqrt(pow(r.x - f.kx, 2) + pow(r.y - f.ky, 2)) >= 5.0
  from fx_tfold f join fx_tn r on r.chunk = f.chunk and r.pass = f.pass and r.i = f.i + 1
),
fx_tracks as (select chunk, pass, seq, round(x, 3) as x, round(y, 3) as y, round(z, 3) as z from fx_tfold where n >= 2 and (kept or i = n or n < 3))"""

_SEAMS = f"""{_TRACKS},
fx_dz as (
  select a.chunk as a, b.chunk as b, abs(cast(round(a.z * 1000) as bigint) - cast(round(b.z * 1000) as bigint)) as dz from fx_tracks a join fx_tracks b
    on floor(a.x / 6.0e0) = floor(b.x / 6.0e0) and floor(a.y / 6.0e0) = floor(b.y / 6.0e0) and a.chunk < b.chunk and pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 36.0e0
),
fx_seams as (select a, b, count(*) as pairs, quantile_cont(dz, 0.5) / 1000 as median_dz, quantile_cont(dz, 0.9) / 1000 as p90_dz from fx_dz group by a, b having count(*) >= 20)"""

_SEGS = f"""{_TRACKS},
fx_segs as (
  select * from (select chunk, x as ax, y as ay, lead(x) over w as bx, lead(y) over w as by_ from fx_tracks window w as (partition by chunk, pass order by seq)) where bx is not null
),
fx_band as (select chunk, min(z) - 1.0e0 as z_lo, max(z) + 1.0e0 as z_hi from fx_tracks group by chunk)"""

_SHARE2 = "greatest(0.0e0, least(1.0e0, ((px - ax) * (bx - ax) + (py - ay) * (by_ - ay)) / greatest((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay), 1e-12)))"

_MERGED = f"""{_SEGS}, {GAUSSIANS_SQL},
      box as (select distinct chunk, cx * 20.0e0 as x0, cy * 20.0e0 as y0, (cx + 1) * 20.0e0 as x1, (cy + 1) * 20.0e0 as y1 from fx_members),
      g as (select g.*, row_number() over () as rid, x >= x0 and x < x1 and y >= y0 and y < y1 as owned from fx_gaussians g join box using (chunk)),
      near as (
        select distinct rid from (
          select g.rid, g.x as px, g.y as py, ax, ay, bx, by_ from g join fx_segs using (chunk) join fx_band using (chunk) where owned and z between z_lo and z_hi
        ) where pow(px - ax - {_SHARE2} * (bx - ax), 2) + pow(py - ay - {_SHARE2} * (by_ - ay), 2) <= 2.25e0
      ),
      k as (select rid from near union select rid from g where owned and chunk not in (select chunk from fx_segs))"""

ORACLES = {
    "frame_sequence": f"with {FRAMES_SQL} select * from fx_frames",
    "geo_round_trip": f"with {FRAMES_SQL} select seq, round(x, 3) as e, round(y, 3) as n, round(z, 3) as u from fx_frames",
    "local_plane": f"""with {FRAMES_SQL}
      select seq, round(radians((-76.69057e0 + x / 86000) - -76.69057e0) * (6378137.0e0 * cos(radians(38.98138e0))), 3) as ax, round(z, 3) as ay, round(-(radians((38.98138e0 + y / 111320) - 38.98138e0) * 6378137.0e0), 3) as az from fx_frames""",
    "chunk_members": f"with {_MEMBERS} select chunk, cx, cy, seq, is_core from fx_members",
    "chunk_manifest": f"with {_MANIFEST} select * from fx_manifest",
    "pass_split": f"with {_PASSES} select video, pass, min(seq) as first_seq, max(seq) as last_seq, count(*) as frames from fx_passes group by 1, 2",
    "corridor_points": f"with recursive {_CORRIDOR} select * from fx_corridor",
    "corridor_band": f"with recursive {_CORRIDOR} select video, round(min(z) - 8.0, 6) as z_lo, round(max(z) + 8.0, 6) as z_hi from fx_corridor group by video",
    "frame_selection": f"""with recursive {FRAMES_SQL},
      d as (select *, sqrt(pow(x - lag(x) over w, 2) + pow(y - lag(y) over w, 2)) as step from fx_frames window w as (partition by video order by seq)),
      c as (select video, cast(floor(t / 60) as int) as seg, seq as i, floor(sum(coalesce(step, 0.0e0)) over (partition by video order by seq rows between unbounded preceding and current row) * 4) as dist, sharp from d),
      n as (select *, row_number() over (partition by video order by seg, i) as k from c),
      f as (
        select video, k, dist + 9.0e0 as mark, cast(null as int) as bseg, cast(null as bigint) as bi, cast(null as double) as bd, cast(null as double) as bs, true as emit, seg as eseg, i as ei, dist as ed, sharp as es from n where k = 1 and dist >= 0
        union all
        select video, k, case when r_take then dist + 9.0e0 else mark end, case when r_take then null else hseg end, case when r_take then null else hi end, case when r_take then null else hd end, case when r_take then null else hs end, r_take, hseg, hi, hd, hs
        from (
          select n.video, n.k, n.dist, f.mark, n.dist >= f.mark as r_take,
            case when own then n.seg else f.bseg end as hseg, case when own then n.i else f.bi end as hi, case when own then n.dist else f.bd end as hd, case when own then n.sharp else f.bs end as hs
          from (select f.*, n2.k as nk, f.bi is null or f.bseg <> n2.seg or n2.sharp > f.bs as own from f join n n2 on n2.video = f.video and n2.k = f.k + 1) f join n on n.video = f.video and n.k = f.nk
        )
      )
      select video, eseg as seg, ei as i, ed as dist, es as sharp from f where emit""",
    "time_nudge": f"""with recursive {FRAMES_SQL},
      s as (select video, seq as i, case when seq % 7 <> 0 then floor(t / 3) end as t, row_number() over (partition by video order by seq) as k from fx_frames),
      f as (
        select video, i, k, case when coalesce(t, -1.0e0) <= -1.0e0 then -1.0e0 + 1e-3 else t end as t from s where k = 1
        union all
        select s.video, s.i, s.k, case when coalesce(s.t, f.t) <= f.t then f.t + 1e-3 else s.t end from f join s on s.video = f.video and s.k = f.k + 1
      )
      select video, i, round(t, 6) as t from f""",
    "telemetry_interpolation": f"""with {FRAMES_SQL},
      s as (select video, t, x, y, z, lead(t) over w as t2, lead(x) over w as x2, lead(y) over w as y2, lead(z) over w as z2, row_number() over w as k from fx_frames where seq % 4 = 0 window w as (partition by video order by t)),
      q as (select video, t + 0.2e0 - (seq % 3) * 0.3e0 as t, seq from fx_frames),
      j as (select q.video, q.t as qt, s.* exclude (video) from q asof left join s on q.video = s.video and q.t >= s.t),
      f as (select video, x as fx, y as fy, z as fz from s where k = 1)
      select j.video, round(qt, 6) as t,
        round(case when k is null then fx when t2 is null then x else x + (x2 - x) * ((qt - t) / (t2 - t)) end, 6) as x,
        round(case when k is null then fy when t2 is null then y else y + (y2 - y) * ((qt - t) / (t2 - t)) end, 6) as y,
        round(case when k is null then fz when t2 is null then z else z + (z2 - z) * ((qt - t) / (t2 - t)) end, 6) as z
      from j join f on f.video = j.video""",
    "seam_pairs": f"with recursive {_SEAMS} select a, b, pairs, round(median_dz, 6) as median_dz, round(p90_dz, 6) as p90_dz, case when median_dz < 1 then 'agree' when median_dz < 3 then 'marginal' else 'DISAGREE' end as verdict from fx_seams",
    "seam_report": f"""with recursive {_SEAMS}, bad as (select a as c from fx_seams where median_dz >= 3 union select b from fx_seams where median_dz >= 3)
      select count(*) as seams, round(quantile_cont(median_dz, 0.5), 6) as median, round(max(median_dz), 6) as worst, (select coalesce(string_agg(c, ',' order by c), '') from bad) as offenders from fx_seams""",
    "seam_gate": f"""with recursive {_SEAMS} select count(*) as seams, round(list_sort(list(median_dz))[count(*) // 2 + 1], 6) as upper_median, round(max(median_dz), 6) as worst, count(*) = 0 as skipped, count(*) > 0 and coalesce(max(median_dz) <= 3, false) as ok from fx_seams""",
    "footprint_overlap": f"""with {_MANIFEST}, h as (select min(x / 3) as hx0, min(y / 3) as hy0, max(x / 3) as hx1, max(y / 3) as hy1 from fx_frames),
      s as (select chunk, greatest(0.0e0, least(x1, hx1) - greatest(x0, hx0)) * greatest(0.0e0, least(y1, hy1) - greatest(y0, hy0)) / ((x1 - x0) * (y1 - y0)) as share from fx_manifest, h)
      select chunk, round(share, 6) as share from s where share > 0.30""",
    "merge_totals": f"""with recursive {_MERGED} select chunk, count(*) as source, count(*) filter (owned) as owned, count(k.rid) as kept from g left join k on k.rid = g.rid group by chunk""",
    "lod_tiles": f"""with {GAUSSIANS_SQL},
      a as (select *, list_reverse_sort([exp(greatest(-30.0e0, least(20.0e0, scale_0))), exp(greatest(-30.0e0, least(20.0e0, scale_1))), exp(greatest(-30.0e0, least(20.0e0, scale_2)))]) as ax from fx_gaussians),
      r as (select *, row_number() over (partition by chunk order by (1 / (1 + exp(-opacity))) * ax[1] * ax[2] desc, idx, p, s, e) as r, count(*) over (partition by chunk) as n from a)
      select chunk, idx, p, s, e, opacity from r where r <= greatest(1, round_even(n * 0.125e0, 0))""",
    "corridor_guard": f"""with recursive {_CORRIDOR},
      seg as (select * from (select x as ax, y as ay, z as az, lead(x) over w as bx, lead(y) over w as by_, lead(z) over w as bz from fx_corridor window w as (partition by video, pass order by seq)) where bx is not null),
      q as (select seq, x + (seq % 9 - 4) as px, y + (seq % 5 - 2) * 1.5e0 as py, z + (seq % 4 - 1) as pz from fx_frames),
      d as (select q.*, ax, ay, az, bx, by_, bz, case when (bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)+(bz-az)*(bz-az) < 1e-12 then 0.0e0 else greatest(0.0e0, least(1.0e0, ((px-ax)*(bx-ax)+(py-ay)*(by_-ay)+(pz-az)*(bz-az)) / greatest((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)+(bz-az)*(bz-az), 1e-12))) end as t from q, seg),
      m as (select seq, min(pow(px - ax - t*(bx-ax), 2) + pow(py - ay - t*(by_-ay), 2) + pow(pz - az - t*(bz-az), 2)) as d2 from d group by seq)
      select q.seq, round(sqrt(d2), 6) as d, sqrt(d2) <= 2 and pz between -1 and 1 as inside from q join m using (seq)""",
    "residual_summary": f"""with {FRAMES_SQL}, d as (select sqrt(pow(x + (seq % 13) / 10.0e0 - x, 2) + pow(y - (seq % 7) / 10.0e0 - y, 2)) as d from fx_frames)
      select count(*) as images, round(quantile_cont(d, 0.5), 6) as median, round(quantile_cont(d, 0.9), 6) as p90, round(max(d), 6) as max from d""",
    "residuals_by_video": f"""with {FRAMES_SQL}, d as (select video, sqrt(pow(x + (seq % 13) / 10.0e0 - x, 2) + pow(y - (seq % 7) / 10.0e0 - y, 2)) as d, (z + seq % 3) - z as v, z + seq % 3 as z from fx_frames)
      select video, count(*) as n, round(quantile_cont(d, 0.5), 6) as horizontal_median, round(quantile_cont(d, 0.9), 6) as horizontal_p90, round(avg(v), 6) as vertical_mean, round(avg(z), 6) as z_mean, round(stddev_pop(z), 6) as z_std from d group by video""",
    "warp_windows": f"""with {FRAMES_SQL},
      p as (select video, seq, x, y, z, x * 1.1e0 - y * 0.2e0 + seq % 5 as u, x * 0.2e0 + y * 1.1e0 - seq % 3 as v, z + seq % 4 as gz from fx_frames),
      c as (select seq, x, y, z, avg(x) over w as mx, avg(y) over w as my, avg(u) over w as mu, avg(v) over w as mv, avg(x*u) over w - avg(x) over w * avg(u) over w + avg(y*v) over w - avg(y) over w * avg(v) over w as p, avg(x*v) over w - avg(x) over w * avg(v) over w - (avg(y*u) over w - avg(y) over w * avg(u) over w) as q,
          avg(x*x) over w - avg(x) over w * avg(x) over w + avg(y*y) over w - avg(y) over w * avg(y) over w as n, list([gz, z]) over w as zs from p window w as (partition by video order by seq rows between 5 preceding and 5 following)),
      s as (select *, atan2(q, p) as yaw, sqrt(p*p + q*q) / greatest(n, 1e-12) as scale from c), t as (select *, list_median(list_transform(zs, lambda r: r[1] - scale * r[2])) as dz from s)
      select seq, round(yaw, 4) as yaw, round(scale, 4) as scale, round(dz, 4) as dz, round(mu + scale * cos(yaw) * (x - mx) - scale * sin(yaw) * (y - my), 4) as wx, round(mv + scale * sin(yaw) * (x - mx) + scale * cos(yaw) * (y - my), 4) as wy, round(scale * z + dz, 3) as wz from t""",
    "path_resample": f"""with {FRAMES_SQL},
      d as (select *, sum(coalesce(sqrt(pow(x - px, 2) + pow(y - py, 2)), 0.0e0)) over (partition by video order by seq rows between unbounded preceding and current row) as dist from (select *, lag(x) over w as px, lag(y) over w as py from fx_frames window w as (partition by video order by seq))),
      l as (select *, lead(dist) over w as d2, lead(x) over w as x2, lead(y) over w as y2, lead(z) over w as z2 from d window w as (partition by video order by seq)),
      m as (select *, unnest(generate_series(cast(ceil(dist / 2.5) as bigint), cast(ceil(d2 / 2.5) as bigint) - 1)) as i from l where d2 > dist)
      select video, i, round(i * 2.5e0, 4) as s, round(x + (x2 - x) * ((i * 2.5e0 - dist) / (d2 - dist)), 4) as x, round(y + (y2 - y) * ((i * 2.5e0 - dist) / (d2 - dist)), 4) as y, round(z + (z2 - z) * ((i * 2.5e0 - dist) / (d2 - dist)), 4) as z from m""",
    "path_smooth": f"""with {FRAMES_SQL},
      e as (select *, row_number() over (partition by video order by seq) - 1 as k, count(*) over (partition by video) as n from fx_frames),
      o as (select e.video, e.seq, e.k, e.n, unnest(generate_series(-4, 4)) as d from e),
      j as (select o.seq, avg(s.x) as x, avg(s.y) as y, avg(s.z) as z from o join e s on s.video = o.video and s.k = greatest(0, least(o.n - 1, o.k + o.d)) group by o.seq)
      select seq as i, round(x, 3) as x, round(y, 3) as y, round(z, 3) as z from j""",
    "path_headings": f"""with {FRAMES_SQL},
      e as (select *, row_number() over (partition by video order by seq) - 1 as k, count(*) over (partition by video) as n from fx_frames),
      j as (select e.seq, a.x - e.x as ox, a.y - e.y as oy, a.z - e.z as oz, e.x - b.x as bx, e.y - b.y as by_, e.z - b.z as bz from e join e a on a.video = e.video and a.k = least(e.n - 1, e.k + 4) join e b on b.video = e.video and b.k = greatest(0, e.k - 4)),
      s as (select *, sqrt(ox*ox + oy*oy + oz*oz) as n, sqrt(bx*bx + by_*by_ + bz*bz) as m from j)
      select seq as i, round(case when n > 1e-9 then ox / n when m > 1e-9 then bx / m else 0 end, 6) as fx, round(case when n > 1e-9 then oy / n when m > 1e-9 then by_ / m else 0 end, 6) as fy, round(case when n > 1e-9 then oz / n when m > 1e-9 then bz / m else 0 end, 6) as fz from s""",
    "road_ribbon": f"""with {FRAMES_SQL},
      a as (select *, lead(x) over w - x as dx, lead(y) over w - y as dy from fx_frames window w as (partition by video order by seq)),
      b as (select *, case when sqrt(dx*dx + dy*dy) > 0 then dx / sqrt(dx*dx + dy*dy) end as ux, case when sqrt(dx*dx + dy*dy) > 0 then dy / sqrt(dx*dx + dy*dy) end as uy from a),
      c as (select *, coalesce(lag(ux) over w, ux, 0) + coalesce(ux, lag(ux) over w, 0) as tx, coalesce(lag(uy) over w, uy, 0) + coalesce(uy, lag(uy) over w, 0) as ty from b window w as (partition by video order by seq)),
      d as (select *, case when sqrt(tx*tx + ty*ty) > 0 then -ty / sqrt(tx*tx + ty*ty) else 0 end as nx, case when sqrt(tx*tx + ty*ty) > 0 then tx / sqrt(tx*tx + ty*ty) else 0 end as ny from c)
      select seq, round(x + nx * 3.0, 4) as lx, round(y + ny * 3.0, 4) as ly, round(x - nx * 3.0, 4) as rx, round(y - ny * 3.0, 4) as ry, round(z - 1.5, 4) as z from d""",
    "pass_pair_matrix": f"""with {FRAMES_SQL},
      r as (select cast(substr(video, 2) as int) as pass, min(seq) as lo, max(seq) as hi from fx_frames group by video),
      i as (select f.seq, min(pass) as pass from fx_frames f join r on f.seq between lo and hi group by f.seq),
      e as (select a.pass as p, b.pass as q from (select seq, k from fx_frames, (values (1), (40), (95)) v(k) where (seq * 7 + k) % 40 > 15) x join i a on a.seq = x.seq join i b on b.seq = x.seq + x.k),
      h as (select least(p, q) as a, greatest(p, q) as b, count(*) as pairs from e group by 1, 2)
      select a, b, pairs from h union all select b, a, pairs from h where a <> b""",
    "queue_state": """with q as (select 'stage' || (user_id % 4) as stage, cast(user_id * 100 + event_id % 97 as varchar) as item, ts, case event_type when 'signup' then 'claim' when 'view' then 'heartbeat' when 'purchase' then 'done' when 'error' then 'failed' end as kind from events),
      s as (select stage, item, count(*) filter (kind = 'done') as done, count(*) filter (kind = 'failed') as failed, max(ts) filter (kind in ('claim', 'heartbeat')) as held, max(ts) filter (kind in ('done', 'failed')) as freed from q where kind is not null group by 1, 2),
      t as (select stage, case when done > 0 then 'done' when held is not null and (freed is null or held > freed) then 'running' when failed >= 2 then 'failed' else 'pending' end as state from s)
      select stage, count(*) filter (state = 'done') as done, count(*) filter (state = 'running') as running, count(*) filter (state = 'failed') as failed, count(*) filter (state = 'pending') as pending from t group by stage""",
    "holdout_common": f"with {FRAMES_SQL} select printf('cam3/%06d.jpg', seq) as name from fx_frames where seq % 8 = 0 and seq % 3 <> 1",
    "sequence_ranking": """with p as (select * from events where event_type <> 'error'), s as (select user_id, count(*) as size from p group by 1 having count(*) >= 60)
      select user_id as sequence, event_id as id, size from p join s using (user_id) where event_id % 11 <> 0 and event_id % 13 <> 0 and value is not null order by size desc, user_id, ts, event_id limit 500""",
    "budget": """select cast(p_partkey as varchar) as path, card_gb, round(b * 8 / s / 1e6, 6) as mbps, round(b / 1e9 / (s / 60), 6) as gb_per_min, round(card_gb / (b / 1e9 / (s / 60)), 4) as minutes, round(card_gb / (b / 1e9 / (s / 60)) / 60 * 15.0e0, 4) as miles
      from (select p_partkey, p_retailprice * 1e6 as b, cast(p_size + 1 as double) as s from part), (values (64), (128), (512), (1024)) v(card_gb)""",
    "clip_pieces": """select o_orderkey, seg, seg * 60.0e0 as start_s, least(d, (seg + 1) * 60.0e0) as end_s
      from (select o_orderkey, cast(o_orderkey % 613 as double) as d, unnest(generate_series(0, cast(ceil((o_orderkey % 613) / 60.0e0) as int) - 1)) as seg from orders where o_orderkey % 613 > 0)""",
    "newest_steps": """with f as (select l_suppkey as chunk, 'out/point_' || (l_partkey * 7 % 1000) || '.ply' as path, l_partkey * 7 % 1000 as step from lineitem)
      select chunk, 'out/point_' || max(step) || '.ply' as path, max(step) as step from f group by chunk""",
    "verdicts": f"""with {FRAMES_SQL} select seq, case when abs(z) < 1 then 'agree' when abs(z) < 3 then 'marginal' else 'DISAGREE' end as verdict, round(10 * log10(1 / greatest(abs(x) / 1e4, 1e-12)), 6) as psnr,
      greatest(32, 6 * greatest(1, seq % 5) * 12 * 2) as neighbours, round(0.5e0 * 1920 / tan(radians(60 + seq % 40) / 2), 6) as fx from fx_frames""",
}

_MATRIX = ORACLES["pass_pair_matrix"].replace("select a, b, pairs from h union all select b, a, pairs from h where a <> b", "").rstrip().rstrip(",")
_MATRIX += ", m as (select a, b, pairs from h union all select b, a, pairs from h where a <> b)"
_VERTICES = f"""{FRAMES_SQL}, v as (select cast(substr(video, 2) as bigint) as pass, seq, x, y, z from fx_frames)"""

ORACLES |= {
    "weak_pass_list": f"""{_MATRIX}, w as (select a as pass, coalesce(sum(pairs) filter (a = b), 0)::bigint as intra, coalesce(sum(pairs) filter (a <> b), 0)::bigint as cross from m group by a)
      select pass, intra, "cross" from w where intra > 0 and "cross" < 1.0 * intra""".replace(" as cross", ' as "cross"'),
    "pass_components": f"""{_MATRIX.replace("with ", "with recursive ", 1)}, l as (select a, b from m), c(node, root) as (select distinct a, a from l union select l.b, c.root from c join l on l.a = c.node)
      select node as pass, min(root) as "group" from c group by node""",
    "capture_centres": f"""with {FRAMES_SQL}, i as (select seq, x + k as x, y, z from fx_frames, (values (0), (1), (2), (3), (4), (5)) v(k) where (seq + k) % 17 <> 0 and (seq + k) % 5 <> 0)
      select seq, round(avg(x), 3) as x, round(avg(y), 3) as y, round(avg(z), 3) as z from i group by seq""",
    "camera_deal": f"""with {_MANIFEST}, seen as (select seq as image_id, x + k * 4 as x, y - k * 2 as y from fx_frames, (values (-3), (-2), (-1), (0), (1), (2), (3)) v(k)),
      near as (select chunk, seq as image_id from fx_frames, fx_manifest where x between x0 - 4 and x1 + 4 and y between y0 - 4 and y1 + 4),
      wide as (select chunk, seq as image_id from fx_frames, fx_manifest where x between x0 - 10 and x1 + 10 and y between y0 - 10 and y1 + 10),
      enough as (select chunk, image_id from seen, fx_manifest where x between x0 and x1 and y between y0 and y1 group by 1, 2 having count(*) >= 3)
      select * from near union select * from wide join enough using (chunk, image_id)""",
    "cell_states": f"""with {_MEMBERS}, few as (select chunk from fx_members where cx % 2 = 0 group by chunk having count(*) >= 2), d as (select chunk, count(*) as dealt, count(*) filter (seq % 17 <> 3) as registered from fx_members where chunk not in (select chunk from few) group by chunk)
      select chunk, dealt, registered, case when registered >= 0.9 * dealt then 'relocated' else 'hole' end as state from d""",
    "coverage_ratio": f"""with {FRAMES_SQL} select count(*) filter (seq % 9 <> 0) as registered, count(*) as reference, round(count(*) filter (seq % 9 <> 0) / count(*)::double, 6) as ratio, count(*) filter (seq % 9 <> 0) >= 0.85 * count(*) as ok from fx_frames""",
    "mean_psnr": f"""with {FRAMES_SQL} select seq % 4 as checkpoint, count(*) as views, round(avg(10 * log10(1 / greatest(abs(x) / 1e4, 1e-12))), 4) as psnr from fx_frames group by 1""",
    "largest_pass": f"""with {_PASSES}, n as (select video, pass, count(*) as points from fx_passes group by 1, 2) select video, pass, points from n qualify row_number() over (partition by video order by points desc, pass) = 1""",
    "pass_cover": f"""with {_VERTICES}, n as (select pass, count(*) as n from v group by pass), h as (select distinct a.pass, a.seq, b.pass as other from v a join v b on a.pass <> b.pass and pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 4)
      select h.pass, other, round(count(*) / any_value(n)::double, 6) as share from h join n on n.pass = h.pass group by h.pass, other""",
    "exact_seams": f"""with recursive {_TRACKS}, d as (select a.chunk as a, b.chunk as b, abs(cast(round(a.z * 1000) as bigint) - cast(round(b.z * 1000) as bigint)) as dz from fx_tracks a join fx_tracks b on a.chunk < b.chunk and pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 36.0e0),
      s as (select a, b, count(*) as pairs, quantile_cont(dz, 0.5) / 1000 as m, quantile_cont(dz, 0.9) / 1000 as p from d group by a, b having count(*) >= 20)
      select a, b, pairs, round(m, 6) as median_dz, round(p, 6) as p90_dz, case when m < 1 then 'agree' when m < 3 then 'marginal' else 'DISAGREE' end as verdict from s""",
    "pass_overlap": f"""with {_VERTICES}, d as (select a.pass as a, b.pass as b, a.seq, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) as d from v a join v b on a.pass < b.pass group by 1, 2, 3),
      n as (select pass, count(*) as n from v group by pass)
      select a, b, count(*) as near, round(count(*) / any_value(n)::double, 6) as share, round(quantile_cont(d, 0.5), 4) as median from d join n on n.pass = a where d < 3 group by a, b""",
    "cube_layouts": """with p as (select distinct p_size * 64 + 3000 as w, p_size * 16 + 900 as h from part), s as (select w, h, (w - h) // 2 as side, (w - h) // 2 - h as blend from p)
      select w, h, side, blend, round((2 * (0.5e0 / (1 - 2 * (blend / side::double))) - 1) * 45, 6) as overlap_deg from s""",
    "lens_pixels": f"""with {FRAMES_SQL}, n as (select seq, x / sqrt(x*x + y*y + z*z) as x, y / sqrt(x*x + y*y + z*z) as y, z / sqrt(x*x + y*y + z*z) as z from fx_frames where x <> 0 and y <> 0),
      t as (select *, acos(greatest(-1, least(1, y))) as th, atan2(-z, x) as phi from n), r as (select *, 2 * sin(th / 2) * 1400 / (2 * sin(radians(100) / 2)) as r from t)
      select seq, round((atan2(x, y) / (2 * pi()) + 0.5e0) * 5760, 3) as ex, round((0.5e0 - asin(greatest(-1, least(1, z))) / pi()) * 2880, 3) as ey, round(1440 - r * cos(phi), 3) as fx, round(1440 - r * sin(phi), 3) as fy, th <= radians(100) as seen from r""",
    "newest_profiles": "select p_brand as name, p_partkey as dir_order, p_size as priority from part qualify row_number() over (partition by p_brand order by p_partkey desc) = 1",
    "missing_images": f"with {FRAMES_SQL} select seq as name from fx_frames where seq % 2 = 0 and seq % 3 = 0",
}

_IMAGES = f"""{FRAMES_SQL}, i as (select seq as image_id, printf('cam%d/%06d.jpg', seq % 3, seq) as name, * from fx_frames)"""
# Left, front, right, down, back, top: the middle's component, and those along columns and rows.
_FACES = f"""{FRAMES_SQL}, fd as (select seq, x, y, z * 20 as z from fx_frames where x <> 0 or y <> 0 or z <> 0),
  ff as (select *, case when abs(y) >= abs(x) and abs(y) >= abs(z) then case when y >= 0 then 'front' else 'back' end when abs(x) >= abs(z) then case when x >= 0 then 'right' else 'left' end when z >= 0 then 'top' else 'down' end as face from fd),
  fq as (select *, case face when 'left' then [y / -x, -z / -x] when 'front' then [x / y, -z / y] when 'right' then [-y / x, -z / x] when 'down' then [-y / -z, -x / -z] when 'back' then [z / -y, -x / -y] else [y / z, -x / z] end as q from ff),
  fu as (select seq, face, least(1 - 1e-7, greatest(0.0e0, (4 / pi() * atan(q[1]) + 1) / 2)) as u, least(1 - 1e-7, greatest(0.0e0, (4 / pi() * atan(q[2]) + 1) / 2)) as v from fq)"""
_QUEUE = """select 'stage' || s as stage, item, case when done > 0 then 'done' when held is not null and (freed is null or held > freed) then 'running' when failed >= 2 then 'failed' else 'pending' end as state
  from (select user_id % 4 as s, cast(user_id * 100 + event_id % 97 as varchar) as item, count(*) filter (event_type = 'purchase') as done, count(*) filter (event_type = 'error') as failed, max(ts) filter (event_type in ('signup', 'view')) as held,
    max(ts) filter (event_type in ('purchase', 'error')) as freed from events where event_type in ('signup', 'view', 'purchase', 'error') group by 1, 2)"""
_LISTING = """l as (select distinct 'chunk_' || p_size as dir, name from (select *, ['corridor.json', 'envelope.json', 'meta.json'][p_partkey % 7 % 3 + 1] as name from part) where p_partkey % 10 < p_size % 4 or name = 'meta.json')"""
_KEPT = f"""{GAUSSIANS_SQL}, n as (select chunk, count(*) as n from fx_gaussians group by chunk)"""

ORACLES |= {
    "manifest_totals": f"with {_MANIFEST} select count(*) as chunks, cast(sum(frames) as bigint) as memberships, cast(sum(core_frames) as bigint) as core_frames from fx_manifest",
    "chunk_files": f"""with {_MANIFEST}, m as (select chunk, count(*) as members, min(seq) as first_seq, round(sum(z), 3) as z from fx_members group by chunk)
      select chunk, members, first_seq, z, frames, core_frames, passes from m join fx_manifest using (chunk)""",
    "world_files": f"""with recursive {_MERGED} select chunk, count(k.rid) as gaussians, cast(sum(p) filter (k.rid is not null) as bigint) as parts, count(*) as source, count(*) filter (owned) as owned, count(k.rid) as kept from g left join k on k.rid = g.rid group by chunk having count(k.rid) > 0""",
    "level_files": f"""with {_KEPT} select name, chunk, cast(keep as double) as keep, cast(greatest(1, round_even(n * keep, 0)) as bigint) as gaussians from n, (values ('far', 0.125e0), ('near', 0.5e0)) v(name, keep)""",
    "lod_rollup": f"""with {_KEPT}, t as (select cast(sum(n) as bigint) as source, cast(sum(greatest(1, round_even(n * 0.125e0, 0))) as bigint) as gaussians from n)
      select source, gaussians, source * 248 as source_bytes, gaussians * 68 as bytes, round(gaussians / source::double, 6) as gaussians_share, round(gaussians * 68 / (source * 248)::double, 6) as bytes_share from t""",
    "envelope_refresh": f"""with recursive {_TRACKS}, e as (select chunk, count(distinct pass) as passes, count(*) as points, round(min(z) - 8.0, 3) as z_lo from fx_tracks group by chunk)
      select chunk, 2 as version, 'sfm' as source, 'current' as kind, cast(passes as int) as passes, cast(points as int) as points, z_lo from e where chunk like '%_y0'
      union all select chunk, 1, 'gps', case when chunk like '%_y0' then 'gps' else 'current' end, cast(passes as int), cast(points as int), z_lo from e""",
    "world_points": f"""with recursive {_TRACKS}, p as (select chunk, pass, count(*) as points, min(seq) as first_seq from fx_tracks group by 1, 2)
      select chunk, row_number() over (order by chunk, pass) - 1 as pass, points, first_seq from p""",
    "world_header": f"""with recursive {_TRACKS} select cast(max(length(chunk)) as double) as radius_m, round(min(z) - 8.0, 6) as z_lo, round(max(z) + 8.0, 6) as z_hi from fx_tracks""",
    "moved_cameras": f"""with {FRAMES_SQL}, m as (select sqrt(pow((x + (seq % 11) / 20.0e0) - x, 2) + pow((y - (seq % 7) / 20.0e0) - y, 2) + pow(z - z, 2)) as m from fx_frames)
      select count(*) as images, round(quantile_cont(m, 0.5), 6) as moved_median, round(max(m), 6) as moved_max, count(*) filter (m > 0.5) as reverted from m""",
    "database_states": f"""with {_MEMBERS}, c as (select chunk, count(*) filter (cy % 2 = 0 or seq % 50 <> 1) as images, count(*) as on_disk, count(*) filter (cx % 5 <> 1 or seq % 20 <> 3) as keypoints, count(*) filter (cx % 3 <> 0 and seq % 3 > 0) as pairs from fx_members group by chunk)
      select *, images = on_disk and keypoints >= images and pairs > 0 as complete from c""",
    "largest_models": f"""with {GAUSSIANS_SQL}, m as (select chunk, p % 3 * (s % 2) as model, sum(idx % 97) as size from fx_gaussians group by 1, 2),
      t as (select *, row_number() over (partition by chunk order by size desc, model) as r, count(*) over (partition by chunk) as models, sum(size) over (partition by chunk) as all_ from m)
      select chunk, model, models, round(case when all_ > 0 then size / all_::double else 0 end, 6) as kept, models > 1 and (case when all_ > 0 then size / all_::double else 0 end) < 0.9e0 as warn from t where r = 1""",
    "black_point_share": f"""with {GAUSSIANS_SQL}, b as (select chunk, case when idx % 3 = 0 and p % 2 * (s % 2) = 0 and floor(s % 5 / 3) = 0 then 1 else 0 end as b from fx_gaussians)
      select chunk, count(*) as points, round(avg(b), 6) as share, avg(b) >= 0.22e0 as dead from b group by chunk""",
    "fenced_frames": f"with {FRAMES_SQL} select seq from fx_frames where x * x + y * y <= 11.1005e0 * 11.1005e0",
    "reachable_segments": f"""with {FRAMES_SQL}, s as (select distinct video, cast(floor(t / 60) as bigint) as seg from fx_frames)
      select video, seg from s where exists (select 1 from fx_frames f where f.video = s.video and f.t between s.seg * 60 - 1 and s.seg * 60 + 61 and x * x + y * y <= 8.0505e0 * 8.0505e0)""",
    "stream_zip": f"""with {FRAMES_SQL}, b as (select video, min(seq) as first, max(seq) as last from fx_frames group by video)
      select video, seq - first as i, t, printf('s0/%06d.jpg,s1/%06d.jpg,s2/%06d.jpg', seq, seq, seq) as paths from fx_frames join b using (video) where seq <= last - 6""",
    "only_named": f"with {_MANIFEST} select chunk as name, frames from fx_manifest where contains(chunk, 'x0_') or contains(chunk, '_y-1')",
    "listed_names": f"with {_IMAGES} select image_id, name from i where seq % 8 = 0",
    "geo_lines": f"with {_IMAGES} select image_id, name as rel, round(x, 3) as lat, round(y, 3) as lon, round(z, 3) as alt from i where seq % 5 <> 0 and seq % 7 <> 0",
    "enu_lines": f"with {_IMAGES} select name, round(x, 3) as x, round(y, 3) as y, round(z, 3) as z from i",
    "frame_lines": f"""with {FRAMES_SQL} select seq, t, case when seq % 10 <> 0 then round(x / 1000, 7) end as lat, round(y / 1000, 7) as lon, video, printf('cam0/%06d.jpg', seq) as cam0, true as plain from fx_frames""",
    "own_frames": f"with {_MEMBERS} select chunk, seq, case when cx % 2 = 0 then 'own-' || video else video end as video from fx_members where cx % 2 = 0 or seq % 3 <> 0",
    "envelope_files": f"with {_LISTING} select dir, case when bool_or(name = 'envelope.json') then 'envelope.json' else 'corridor.json' end as name from l where name <> 'meta.json' group by dir",
    "rename_plan": f"""with {_LISTING} select dir, case when not bool_or(name = 'corridor.json') then 'skip' when bool_or(name = 'envelope.json') then 'clash' else 'rename' end as state from l where name <> 'meta.json' group by dir""",
    "sequential_pairs": f"""with {_IMAGES}, n as (select image_id, row_number() over (order by name, image_id) as k from i) select a.image_id as a, b.image_id as b from n a join n b on b.k between a.k + 1 and a.k + 5""",
    "group_summary": f"""{_MATRIX.replace("with ", "with recursive ", 1)}, c(node, root) as (select distinct a, a from m union select m.b, c.root from c join m on m.a = c.node), g as (select node, min(root) as root from c group by node),
      p as (select root, string_agg(cast(node as varchar), ',' order by node) as passes from g group by root)
      select count(*) as groups, string_agg(passes, ';' order by root) as passes, count(*) > 1 as disconnected from p""",
    "telemetry_tags": f"""with {FRAMES_SQL}, k as (select video, x / 1000 as lat, y / 1000 as lon, row_number() over (partition by video order by seq) as k from fx_frames),
      s as (select *, k + case k % 3 when 0 then 0.5e0 when 1 then 0.25e0 else 0 end as stamp, row_number() over (partition by video order by k) - 1 as i from k where k % 9 <> 0)
      select video, i, round(stamp - first(stamp) over (partition by video order by k), 3) as t, round(lat, 7) as lat, round(lon, 7) as lon, case when k % 4 <> 0 then 12.5e0 else 0 end as alt from s""",
    "trimmed_starts": f"""with {FRAMES_SQL},
      n as (select video, seq, x - lag(x) over w as ax, y - lag(y) over w as ay, lead(x) over w - x as bx, lead(y) over w - y as by_ from fx_frames window w as (partition by video order by seq)),
      d as (select *, sum(coalesce(sqrt(ax * ax + ay * ay), 0.0e0)) over (partition by video order by seq rows between unbounded preceding and current row) as dist, sqrt(ax * ax + ay * ay) * sqrt(bx * bx + by_ * by_) as nm from n),
      f as (select *, max(case when nm > 0 and degrees(acos(greatest(-1.0e0, least(1.0e0, (ax * bx + ay * by_) / nm)))) > 120 and dist <= 25 then seq end) over (partition by video) as last from d)
      select video, seq from f where seq >= coalesce(last, seq)""",
    "reprojection": f"""with {FRAMES_SQL}, p as (select seq % 1000 as u, seq % 700 as v, x, y, z + 200 as z from fx_frames),
      c as (select u, v, 800 * (x + 1) / (z + 3) + 500 as pu, 810 * (y + 2) / (z + 3) + 400 as pv from p where z + 3 > 0 union all select u, v, 700 * -y / z + 10, 700 * x / z + 20 from p where z > 0)
      select count(*) as observations, round(sqrt(avg(pow(pu - u, 2) + pow(pv - v, 2))), 4) as rms from c""",
    "profile_matches": """with f as (select 'a/' || p_partkey || ['.360', '.MP4', '.insv', '.txt'][p_partkey % 4 + 1] as path, p_partkey % 4 as k, p_size % 3 as tracks, p_size % 2 = 0 as wide from part)
      select path, case when k < 2 and wide then 'wide' when k = 0 and tracks = 2 then 'max' when tracks = 2 then 'two' else 'any' end as profile, cast(case when k < 2 and wide then 105 when k = 0 and tracks = 2 then 10 when tracks = 2 then 3 else 0 end as int) as score from f""",
    "probe_rates": "select p_partkey, case when p_partkey % 3 > 0 then round(p_size * 1000 / (p_partkey % 3 * 1001)::double, 6) end as fps from part",
    "metre_degrees": f"with {FRAMES_SQL} select seq, round(y * (1 / 111320.0e0), 9) as dlat, round(x * (1 / (111320.0e0 * cos(radians(38.98138e0)))), 9) as dlon from fx_frames",
    "ray_directions": """with g as (select p_partkey, p_partkey % 64 + 0.5e0 as i, p_size % 32 + 0.5e0 as j from part),
      r as (select *, (i - 32) / 40 as u, (16 - j) / 45 as v, (i / 64 - 0.5e0) * 2 * pi() as lon, (0.5e0 - j / 32) * pi() as lat from g), n as (select *, sqrt(u * u + v * v + 1) as n from r)
      select p_partkey, round(u / n, 6) as px, round(1 / n, 6) as py, round(v / n, 6) as pz, round(cos(lat) * sin(lon), 6) as ex, round(cos(lat) * cos(lon), 6) as ey, round(sin(lat), 6) as ez from n""",
    "cube_faces": f"""with {_FACES} select seq, face, round(u, 5) as u, round(v, 5) as v from fu""",
    "cube_pixels": f"""with {_FACES}, l as (select *, face in ('left', 'top') = (lens = 0) as second, face in ('front', 'back') as middle from fu, (values (0), (1)) t(lens)),
      p as (select *, case when middle then 2016 when face in ('left', 'down') then 0 else 3936 end as x0, case when middle then 1920 else 2016 end as w,
        case when middle then u * 1920 else ((1 - 2 * (96 / 2016.0e0)) * u + case when second then 2 * (96 / 2016.0e0) else 0 end) * 2016 end as at_, 1 / (2 - 4 * (96 / 2016.0e0)) as reach from l)
      select seq, lens, case when face in ('left', 'front', 'right') then 0 else 1 end as track, round(greatest(x0, least(x0 + w - 1.0e0, x0 + at_ - 0.5e0)), 3) as px, round(greatest(0, least(1919.0e0, v * 1920 - 0.5e0)), 3) as py,
        case when middle then (face = 'front') = (lens = 0) when second then u >= 1 - reach else u <= reach end as covered from p""",
    "flat_frames": """with p as (select distinct p_brand || '/' || p_size || '.jpg' as path from part) select row_number() over (order by path) - 1 as seq, path, printf('cam0/%06d.jpg', row_number() over (order by path) - 1) as image, true as flat from p""",
    "camera_specs": """with f as (select distinct case when p_size % 7 = 0 then 'rig' else 'cam' end || p_size as cam, case when p_size % 7 = 0 then 0 else p_size end as idx from part) select cam, idx, case when idx < 30 then cast(idx * 15 as bigint) end as yaw from f""",
    "failed_items": """with t as (%s), f as (select stage, item, row_number() over (partition by stage order by item) as k, count(*) over (partition by stage) as failed from t where state = 'failed')
      select stage, failed, string_agg(item, ',' order by item) as first from f where k <= 6 group by 1, 2""" % _QUEUE,
    "open_items": "select stage, item from (%s) t where state in ('failed', 'pending')" % _QUEUE,
}

# The chain of passes: retraces fall out one after the other, longest pass first; then each pass joins at the nearest free end.
_ROUTE = f"""{_VERTICES},
  d as (select *, sqrt(pow(x - lag(x) over w, 2) + pow(y - lag(y) over w, 2) + pow(z - lag(z) over w, 2)) as d from v window w as (partition by pass order by seq)),
  len as (select pass, sum(coalesce(d, 0)) as length, count(*) as n, arg_min([x, y, z], seq) as s, arg_max([x, y, z], seq) as e from d group by pass having sum(coalesce(d, 0)) >= 5.0),
  lo as materialized (select *, row_number() over (order by length desc, pass) as k from len),
  nv as (select v.*, k from v join lo using (pass)),
  ot as (select a.pass, a.seq, list(distinct b.pass) as others from nv a join nv b on b.k < a.k and pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 4 group by 1, 2),
  pat as materialized (select pass, list_sort(others) as others, count(*) as c from ot group by 1, 2),
  fold(k, kept) as (
    select 0::bigint, []::bigint[]
    union all
    select lo.k, case when len(f.kept) = 0 or coalesce((select sum(c) from pat where pat.pass = lo.pass and list_has_any(pat.others, f.kept)), 0) < 0.9 * lo.n then list_append(f.kept, lo.pass) else f.kept end
    from fold f join lo on lo.k = f.k + 1
  ),
  kp as materialized (select pass, row_number() over (order by k) as k, s, e from lo where list_contains((select arg_max(kept, k) from fold), pass)),
  en as materialized (select pass, k, false as flip, s as p, e as q from kp union all select pass, k, true, e, s from kp),
  g as (select a.pass, a.k, a.flip, coalesce(min(sqrt(pow(a.p[1] - b.p[1], 2) + pow(a.p[2] - b.p[2], 2) + pow(a.p[3] - b.p[3], 2))), 'infinity'::double) as far from en a left join en b on a.pass <> b.pass group by 1, 2, 3),
  st as (select pass, flip from g order by far desc, k, flip limit 1),
  ch(ord, pass, flip, gap_m, tail, used) as (
    select 0, en.pass, en.flip, 0.0::double, en.q, [en.pass] from en join st using (pass, flip)
    union all
    select ord, pass, flip, gap, q, list_append(used, pass) from (
      select ch.ord + 1 as ord, en.pass, en.flip, sqrt(pow(ch.tail[1] - en.p[1], 2) + pow(ch.tail[2] - en.p[2], 2) + pow(ch.tail[3] - en.p[3], 2)) as gap, en.q, ch.used, en.k
      from ch join en on not list_contains(ch.used, en.pass)
    ) qualify row_number() over (order by gap, k, flip) = 1 and gap <= 60.0
  )"""

_RIBBON = f"""{_CORRIDOR},
  pt as (select cast(substr(video, 2) as int) * 100000 + pass as pass, seq, x, y, z from fx_corridor),
  ra as (select *, lead(x) over w - x as dx, lead(y) over w - y as dy from pt window w as (partition by pass order by seq)),
  rb as (select *, case when sqrt(dx*dx + dy*dy) > 0 then dx / sqrt(dx*dx + dy*dy) end as ux, case when sqrt(dx*dx + dy*dy) > 0 then dy / sqrt(dx*dx + dy*dy) end as uy from ra),
  rc as (select *, coalesce(lag(ux) over w, ux, 0) + coalesce(ux, lag(ux) over w, 0) as tx, coalesce(lag(uy) over w, uy, 0) + coalesce(uy, lag(uy) over w, 0) as ty from rb window w as (partition by pass order by seq)),
  rd as (select *, case when sqrt(tx*tx + ty*ty) > 0 then -ty / sqrt(tx*tx + ty*ty) else 0 end as nx, case when sqrt(tx*tx + ty*ty) > 0 then tx / sqrt(tx*tx + ty*ty) else 0 end as ny from rc),
  re as (select *, row_number() over (order by pass, seq) - 1 as n, lead(seq) over (partition by pass order by seq) is not null as inner_ from rd)"""

ORACLES |= {
    "route_chain": f"with recursive {_ROUTE} select ord, pass, flip, gap_m from ch",
    "route_summary": f"""with recursive {_ROUTE}, o as (select ch.ord, v.*, row_number() over (partition by ch.ord order by case when flip then -seq else seq end) as i from ch join v using (pass)),
      r as (select ord, i, round(x, 3) as x, round(y, 3) as y, round(z, 3) as z from o), s as (select *, sqrt(pow(x - lag(x) over w, 2) + pow(y - lag(y) over w, 2) + pow(z - lag(z) over w, 2)) as d from r window w as (partition by ord order by i)),
      f as (select arg_min([x, y, z], [ord, i]) as s, arg_max([x, y, z], [ord, i]) as e, sum(coalesce(d, 0)) as l from s)
      select (select count(*) from ch) as passes, (select count(distinct pass) from v) - (select count(*) from ch) as dropped_passes, round(l + (select sum(gap_m) from ch), 3) as length_m,
        round(s[1], 3) as start_x, round(s[2], 3) as start_y, round(s[3], 3) as start_z, round(e[1], 3) as finish_x, round(e[2], 3) as finish_y, round(e[3], 3) as finish_z from f""",
    "road_lines": f"""with recursive {_RIBBON}
      select 1 as part, n * 2 as ord, printf('v %.4f %.4f %.4f', x + nx * 3.0e0 + 0.0e0, z - 2.4e0 + 0.0e0, -(y + ny * 3.0e0) + 0.0e0) as line from re
      union all select 1, n * 2 + 1, printf('v %.4f %.4f %.4f', x - nx * 3.0e0 + 0.0e0, z - 2.4e0 + 0.0e0, -(y - ny * 3.0e0) + 0.0e0) from re
      union all select 2, n * 2, printf('f %d %d %d', n * 2 + 1, n * 2 + 3, n * 2 + 4) from re where inner_
      union all select 2, n * 2 + 1, printf('f %d %d %d', n * 2 + 1, n * 2 + 4, n * 2 + 2) from re where inner_""",
    "centre_lines": f"""with recursive {_CORRIDOR}, p as (select cast(substr(video, 2) as int) * 100000 + pass as pass, seq, x, y, z from fx_corridor),
      n as (select *, row_number() over (order by pass, seq) - 1 as n, lead(seq) over (partition by pass order by seq) is not null as inner_ from p)
      select 1 as part, n as ord, printf('v %.4f %.4f %.4f', x + 0.0e0, y + 0.0e0, z - 2.4e0 + 0.0e0) as line from n union all select 2, n, printf('l %d %d', n + 1, n + 2) from n where inner_""",
    "frame_records": f"with {FRAMES_SQL} select seq, t, video, printf('cam0/%06d.jpg,cam1/%06d.jpg,cam2/%06d.jpg', seq, seq, seq) as images from fx_frames",
    "chunk_folders": "select 'chunk_' || p_size as chunk, count(*) as images from part where p_size % 3 > 0 and p_partkey % 5 = 0 group by p_size",
    "minute_stream": """with m as (select 'v' || user_id as video, date_trunc('minute', ts) as minute, count(*) as frames from events group by 1, 2)
      select video, count(*) as minutes, cast(sum(frames) as bigint) as frames from m where minute + interval 1 minute <= (select max(ts) - interval 1 minute from events) group by video""",
}

# Rays of a pinhole (u, 1, v), pitched and turned: (dx, dy, dz).
_RAYS = """select *, (u * cos(radians(yaw)) + (cos(radians(pitch)) - v * sin(radians(pitch))) * sin(radians(yaw))) / sqrt(u * u + v * v + 1) as dx,
    (-u * sin(radians(yaw)) + (cos(radians(pitch)) - v * sin(radians(pitch))) * cos(radians(yaw))) / sqrt(u * u + v * v + 1) as dy, (sin(radians(pitch)) + v * cos(radians(pitch))) / sqrt(u * u + v * v + 1) as dz"""
_VIEWS = "v as (select p_size as view, p_size * 7.3e0 as yaw, (p_size % 5 - 2) * 9.1e0 as pitch, p_size % 4 * 15.0e0 + 40.3e0 as fov from (select distinct p_size from part))"
_LENSES = "ln(lens, yaw_deg, ax, ay, az, half) as (values ('front', 0.0e0, 0.0e0, 1.0e0, 0.0e0, 95.0e0), ('back', 180.0e0, 0.0e0, -1.0e0, 0.0e0, 95.0e0), ('all', 0.0e0, 0.0e0, 1.0e0, 0.0e0, 180.0e0), ('narrow', 90.0e0, 1.0e0, 0.0e0, 0.0e0, 20.0e0))"
# A corner at distance r of the vertical axis and bearing b stays in a level lens while it turns by less than acos(cos(half) / r) - |b|.
_PLAN = f"""lp as (select distinct p_size as lens, p_size * 297 % 3600 / 10.0e0 as yaw_deg, p_size * 3.3e0 + 15 as half from part),
  ln as (select lens, yaw_deg, sin(radians(yaw_deg)) as ax, cos(radians(yaw_deg)) as ay, 0.0e0 as az, half from lp), pi_(pitch) as (values (-12.0e0), (5.0e0)), cn(sx, sy) as (values (-1, -1), (-1, 1), (1, -1), (1, 1)),
  co as (select lens, yaw_deg, half, pitch, sx * tan(radians(40)) as u, sy * tan(radians(40)) * 0.75e0 as v, 0.0e0 as yaw from ln, pi_, cn),
  ry as ({_RAYS} from co),
  mo as (select lens, yaw_deg, half, pitch, min(case when cos(radians(half)) / sqrt(dx * dx + dy * dy) <= -1 then 180 when cos(radians(half)) / sqrt(dx * dx + dy * dy) >= 1 then 0 else degrees(acos(cos(radians(half)) / sqrt(dx * dx + dy * dy))) - degrees(abs(atan2(dx, dy))) end) as most from ry group by 1, 2, 3, 4),
  nn as (select *, case when half >= 179 then 6 when most <= 1e-6 then 1 else 1 + cast(ceil(2 * most / 68) as int) end as n from mo),
  pl as (select lens, yaw_deg + case when half >= 179 then i * 60.0e0 when n = 1 then 0 else 2 * most * i / (n - 1) - most end as yaw, pitch from (select *, unnest(generate_series(0, n - 1)) as i from nn))"""

ORACLES |= {
    "view_plan": f"with {_PLAN} select lens, round(yaw, 3) as yaw, pitch, 80.0e0 as fov, 1920 as width, 1440 as height from pl",
    "view_split": f"""with {_VIEWS}, {_LENSES}, g as (select view, yaw, pitch, (i + 0.5e0 - 24) * tan(radians(fov) / 2) / 24 as u, -(j + 0.5e0 - 18) * tan(radians(fov) / 2) / 24 as v from v, (select unnest(generate_series(0, 47)) as i), (select unnest(generate_series(0, 35)) as j)),
      r as ({_RAYS} from g), c as (select view, lens, avg(case when dx * ax + dy * ay + dz * az >= cos(radians(half)) then 1 else 0 end) as c from r, ln where lens <> 'all' group by 1, 2)
      select view, lens, round(c, 6) as coverage from c where c >= 0.10e0""",
    "seam_bands": f"""with {_VIEWS}, g as (select view, yaw, pitch, (i + 0.5e0 - 30) * tan(radians(fov) / 2) / 30 as u, -(j + 0.5e0 - 22.5e0) * tan(radians(fov) / 2) / 30 as v from v, (select unnest(generate_series(0, 59)) as i), (select unnest(generate_series(0, 44)) as j)),
      r as ({_RAYS} from g) select view, round(avg(case when abs(dy) < sin(radians(6.1e0)) then 1 else 0 end), 6) as share from r group by view""",
    "sphere_shares": f"""with {_PLAN}, w as (select pl.lens, round(yaw, 3) as yaw, pitch, ax, ay, az, half from pl join ln using (lens) where pitch < 0 and pl.lens < 30),
      e as (select (i + 0.5e0) / 128 * 2 * pi() - pi() as lon, 1 - (j + 0.5e0) / 32 as z from (select unnest(generate_series(0, 127)) as i), (select unnest(generate_series(0, 63)) as j)),
      d as (select lon, z, sqrt(1 - z * z) * sin(lon) as x, sqrt(1 - z * z) * cos(lon) as y from e),
      t as (select lon, z, x * ax + y * ay + z * az >= cos(radians(half)) as sees, x * cos(radians(yaw)) - y * sin(radians(yaw)) as lx, x * sin(radians(yaw)) + y * cos(radians(yaw)) as ty, pitch from d, w),
      q as (select lon, z, sees, lx, ty * cos(radians(pitch)) + z * sin(radians(pitch)) as ly, -ty * sin(radians(pitch)) + z * cos(radians(pitch)) as lz from t),
      s as (select lon, z, max(case when sees and ly > 0 and abs(lx) <= ly * tan(radians(40)) and abs(lz) <= ly * tan(radians(40)) * 0.75e0 then 1 else 0 end) as seen from q group by 1, 2)
      select round(avg(seen), 6) as sphere, round(avg(seen) filter (abs(z) <= sin(radians(10))), 6) as horizon_band from s""",
}

# DuckDB rounds small negative numbers to -0.0, Spark to 0.0; adding 0.0 makes them one.
ORACLES = {name: sql.replace(" round(", " 0.0e0 + round(") for name, sql in (ORACLES | pictures.ORACLES | streams.ORACLES | round_trips.ORACLES | {"selection_stream": ORACLES["frame_selection"]}).items()}
