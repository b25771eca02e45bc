"""Episodes recomputed by a plain Python loop over the stored flag rows
(a third implementation next to Spark and the SQL oracle)."""

import datetime as dt
from collections import defaultdict

from stayframe.plans import registry  # noqa: F401  (registers concepts)
from stayframe.plans.base import Concepts
from stayframe.sources.fixture import Tables

SF = "/root/testdata/sf0.001"
GAP = dt.timedelta(hours=8)


def _episodes(rows):
    by_stay = defaultdict(list)
    for r in rows:
        if r.mechvent == 1 or r.extubated == 1:
            by_stay[r.icustay_id].append(r)
    out = {}
    for stay, rs in by_stay.items():
        rs.sort(key=lambda r: (r.charttime, r.mechvent, r.extubated, r.selfextubated))
        newvent, prev_on = [], None
        for i, r in enumerate(rs):
            prev = rs[i - 1] if i else None
            if r.extubated == 1:
                nv = 0
            elif r.mechvent == 1 and prev is not None and prev.extubated == 1:
                nv = 1
            elif r.mechvent == 1 and prev_on is not None and r.charttime - prev_on > GAP:
                nv = 1
            elif r.mechvent == 1 and prev_on is None:
                nv = 1
            else:
                nv = 0
            newvent.append(nv)
            if r.mechvent == 1:
                prev_on = r.charttime
        groups = defaultdict(list)
        for i, r in enumerate(rs):
            if r.mechvent != 1:
                continue
            # RANGE frame: every row at or before this time, peers included
            num = sum(n for j, n in enumerate(newvent) if rs[j].charttime <= r.charttime)
            if num >= 1:
                lead = rs[i + 1].charttime if i + 1 < len(rs) else None
                groups[num].append((r.charttime, lead))
        for num, g in groups.items():
            start, last = min(t for t, _ in g), max(t for t, _ in g)
            leads = [ld for _, ld in g if ld is not None]
            end = (max(leads) if leads else None) if start == last else last
            out[(stay, num)] = (start, end)
    return out


def test_episodes_match_python_loop(spark):
    c = Concepts(Tables(spark, SF))
    want = _episodes(c.get("vent_settings").collect())
    got = {(r.icustay_id, r.ventnum): (r.starttime, r.endtime)
           for r in c.get("vent_durations").collect()}
    assert got == want and len(got) > 0


def _day_open(delta: dt.timedelta):
    s = dt.timedelta(seconds=1)
    day = dt.timedelta(hours=24)
    if delta <= day:
        return 1
    for k in range(2, 8):
        if (k - 1) * day + s < delta < k * day:
            return k
    return None


def test_peep_twm_matches_python_loop(spark):
    from stayframe.plans.respiratory import TWM_CONCEPTS
    origin_items, value_items, _ = TWM_CONCEPTS["peep"]
    c = Concepts(Tables(spark, SF))
    stays = {r.icustay_id for r in c.get("cohort").select("icustay_id").collect()}
    ce = [r for r in c.t.chartevents.where(
        c.t.chartevents.itemid.isin(*origin_items)).collect() if r.icustay_id in stays]
    origin = {}
    for r in ce:
        origin[r.icustay_id] = min(origin.get(r.icustay_id, r.charttime), r.charttime)
    vals = defaultdict(list)
    for r in ce:
        if r.itemid in value_items:
            vals[r.icustay_id].append(r)
    groups = defaultdict(list)
    for stay, rs in vals.items():
        rs.sort(key=lambda r: (r.charttime, r.row_id))
        for i, r in enumerate(rs):
            w = None
            if i:
                gap = r.charttime - rs[i - 1].charttime
                w = (gap.days * 86400 + gap.seconds) // 3600 % 24   # hour field
            groups[(stay, _day_open(r.charttime - origin[stay]), r.itemid)].append((r.valuenum, w))
    want = set()
    for (stay, day, _), g in groups.items():
        vs = [v for v, _ in g if v is not None]
        sw = sum(w for _, w in g if w is not None) if any(w is not None for _, w in g) else None
        prods = [v * w for v, w in g if v is not None and w is not None]
        svw = sum(prods) if prods else None
        mx = max(vs) if vs else None
        twm = mx if (sw == 0 or svw == 0) else (svw / sw if sw is not None and svw is not None
                                                  else None)
        want.add((stay, day, None if twm is None else round(twm, 6)))
    got = {(r.icustay_id, r.day, None if r.peep_twm is None else round(r.peep_twm, 6))
           for r in c.get("table_peep").collect()}
    assert got == want and len(got) > 0


def test_asof_spo2_matches_python_loop(spark):
    c = Concepts(Tables(spark, SF))
    gas = [r for r in c.get("blood_gas_pivot").collect() if r.po2 is not None]
    spo2 = defaultdict(dict)
    for r in c.t.chartevents.where(c.t.chartevents.itemid.isin(646, 220277)).collect():
        v = r.valuenum if r.valuenum is not None and 0 < r.valuenum <= 100 else None
        cur = spo2[r.icustay_id].get(r.charttime, "missing")
        spo2[r.icustay_id][r.charttime] = v if cur == "missing" else (
            v if cur is None else (cur if v is None else max(cur, v)))
    want = {}
    for g in gas:
        cands = [t for t in spo2.get(g.icustay_id, {})
                 if g.charttime - dt.timedelta(hours=2) <= t <= g.charttime]
        want[(g.icustay_id, g.charttime)] = spo2[g.icustay_id][max(cands)] if cands else None
    got = {(r.icustay_id, r.charttime): r.spo2 for r in c.get("asof_spo2").collect()}
    assert got == want and len(got) > 0


def test_vent_day_flags_match_python_loop(spark):
    c = Concepts(Tables(spark, SF))
    eps = c.get("cohort_episodes").collect()
    rows = []
    for e in eps:
        s = (e.starttime - e.admittime).total_seconds() / 3600
        end = None if e.endtime is None else (e.endtime - e.admittime).total_seconds() / 3600
        for day in range(1, 8):
            lo, hi = (day - 1) * 24, day * 24
            if (lo < s <= hi) or (s <= lo and end is not None and end > lo):
                rows.append((e.icustay_id, day))
    counts = defaultdict(int)
    for k in rows:
        counts[k] += 1
    want = sorted((stay, day, counts[(stay, day)]) for stay, day in rows)
    got = sorted((r.icustay_id, r.day, r.mechvent_perday) for r in c.get("vent_day_flags").collect())
    assert got == want and len(got) > 0


def test_urine_pivot_matches_python_loop(spark):
    c = Concepts(Tables(spark, SF))
    bins = c.get("urine_binned").collect()
    days = defaultdict(list)
    for b in bins:
        days[(b.icustay_id, b.day_24h)].append(b)
    want = set()
    for (stay, d), bs in days.items():
        d12 = sorted(bs, key=lambda b: b.day_12h)
        first, last = d12[0], d12[-1]
        u12_1 = first.urine_12h_kgh if first.day_12h // d == 1 else None
        u12_2 = last.urine_12h_kgh if last.day_12h // d == 2 else None
        slots = []
        for k in range(1, 5):
            vals = [b.urine_6h_kgh for b in bs
                    if (b.day_6h - 1) % 4 == k - 1 and b.urine_6h_kgh is not None]
            slots.append(max(vals) if vals else None)
        r6 = lambda x: None if x is None else round(x, 6)
        want.add((stay, d, r6(bs[0].urine_24h_kgh), r6(u12_1), r6(u12_2), *map(r6, slots)))
    got = {(r.icustay_id, r.day_24h, *(None if v is None else round(v, 6) for v in (
        r.urine_24h_kgh, r.urine_12h_kgh_1, r.urine_12h_kgh_2, r.urine_6h_kgh_1,
        r.urine_6h_kgh_2, r.urine_6h_kgh_3, r.urine_6h_kgh_4)))
        for r in c.get("urine_pivot").collect()}
    assert got == want and len(got) > 0


def test_mpp_nearest_matches_python_loop(spark):
    from stayframe.plans.hemodynamics import CVP_ITEMS, MAP_ITEMS
    c = Concepts(Tables(spark, SF))
    stays = {r.icustay_id for r in c.get("cohort").select("icustay_id").collect()}
    rows = defaultdict(list)
    for r in c.t.chartevents.where(c.t.chartevents.itemid.isin(*(MAP_ITEMS + CVP_ITEMS))) \
            .collect():
        if r.icustay_id in stays:
            rows[r.icustay_id].append(r)

    def val(r, items):
        v = r.valuenum
        return v if r.itemid in items and v is not None and 0 < v < 200 else None

    want = {}
    for stay, rs in rows.items():
        rs.sort(key=lambda r: (r.charttime, r.row_id))
        n = len(rs)
        for i, r in enumerate(rs):
            cvp = val(r, CVP_ITEMS)

            def at(j):
                return rs[j] if 0 <= j < n else None

            def dist(o):
                return None if o is None else abs((r.charttime - o.charttime).total_seconds())

            def mabp(o):
                return None if o is None else val(o, MAP_ITEMS)

            def gt(a, b):
                return a is not None and b is not None and a > b

            p1, n1, p2, n2 = at(i - 1), at(i + 1), at(i - 2), at(i + 2)
            if cvp is None:
                mpp = None
            elif gt(dist(n1), dist(p1)) and mabp(p1) is not None:
                mpp = mabp(p1) - cvp
            elif (dist(n1) is not None and dist(p1) is not None and dist(n1) <= dist(p1)
                  and mabp(n1) is not None):
                mpp = mabp(n1) - cvp
            elif gt(dist(n2), dist(p2)) and mabp(p1) is None:
                mpp = None if mabp(p2) is None else mabp(p2) - cvp
            elif gt(dist(p2), dist(n2)) and mabp(n1) is None:
                mpp = None if mabp(n2) is None else mabp(n2) - cvp
            else:
                mpp = None
            want[r.row_id] = None if mpp is None else round(mpp, 6)
    got_df = c.get("mpp_nearest")
    got = {r.row_id: None if r.mpp is None else round(r.mpp, 6) for r in got_df.collect()}
    assert got == want and len(got) > 0


def test_gcs_min_matches_python_loop(spark):
    c = Concepts(Tables(spark, SF))
    stays = {r.icustay_id: r.intime for r in c.t.icustays.collect()}
    merge = {723: 723, 223900: 723, 454: 454, 223901: 454, 184: 184, 220739: 184}
    per = defaultdict(lambda: defaultdict(dict))
    for r in c.t.chartevents.where(c.t.chartevents.itemid.isin(*merge)).collect():
        if r.error == 1 or r.icustay_id not in stays:
            continue
        if not stays[r.icustay_id] <= r.charttime <= stays[r.icustay_id] + dt.timedelta(days=1):
            continue
        v = r.valuenum
        if (r.itemid == 723 and r.value == "1.0 ET/Trach") or \
                (r.itemid == 223900 and r.value == "No Response-ETT"):
            v = 0
        slot = per[r.icustay_id][r.charttime]
        key = merge[r.itemid]
        if v is not None:
            slot[key] = max(slot[key], v) if slot.get(key) is not None else v
        else:
            slot.setdefault(key, None)
    want = {}
    for stay, times in per.items():
        best, prev = None, None
        for t in sorted(times):
            m, vb, e = times[t].get(454), times[t].get(723), times[t].get(184)
            near = prev is not None and t - prev[0] < dt.timedelta(hours=6)
            pm, pv, pe = prev[1:] if near else (None, None, None)
            if vb == 0 or (vb is None and pv == 0):
                gcs = 15
            elif pv == 0:
                gcs = (6 if m is None else m) + (5 if vb is None else vb) + (4 if e is None else e)
            else:
                gcs = ((m if m is not None else (pm if pm is not None else 6))
                       + (vb if vb is not None else (pv if pv is not None else 5))
                       + (e if e is not None else (pe if pe is not None else 4)))
            row = (gcs, t, m if m is not None else pm, vb if vb is not None else pv,
                   e if e is not None else pe)
            if best is None or (row[0], row[1]) < (best[0], best[1]):
                best = row
            prev = (t, m, vb, e)
        want[stay] = (best[0], best[2], best[3], best[4])
    got = {r.icustay_id: (r.mingcs, r.gcsmotor, r.gcsverbal, r.gcseyes)
           for r in c.get("gcs_min").collect() if r.mingcs is not None}
    assert got == want and len(got) > 0


def _lt(a, b):
    return a is not None and a < b


def _ge(a, b):
    return a is not None and a >= b


def test_kdigo_rules_match_python(spark):
    """The stated KDIGO rule table against a direct Python reading of the rules."""
    c = Concepts(Tables(spark, SF))
    bad = []
    for r in c.get("kdigo_stage").collect():
        ratio = None if r.creat_max is None else r.creat_max / r.mdrd_creat75
        diff = None if r.creat_max is None else r.creat_max - r.mdrd_creat75
        u6, u12, u24 = r.urine_6h_kgh, r.urine_12h_kgh, r.urine_24h_kgh
        if (ratio is not None and 1.5 <= ratio <= 1.9) or _ge(diff, 26.5) or \
                (_lt(u6, 0.5) and _ge(u12, 0.5) and _ge(u24, 3)):
            k = 1
        elif (ratio is not None and 2 <= ratio <= 2.9) or (_lt(u12, 0.5) and _ge(u24, 0.3)):
            k = 2
        elif _ge(ratio, 3) or _ge(diff, 353.6) or _lt(u24, 0.3) or u12 == 0 or r.rrt == 1:
            k = 3
        else:
            k = None
        if k != r.kdigo:
            bad.append((r, k))
    assert not bad


def test_sofa_rules_match_python(spark):
    """SOFA components from the first-day inputs, by a direct Python reading."""
    c = Concepts(Tables(spark, SF))
    labs = {r.icustay_id: r for r in c.get("labs_first_day").collect()}
    uo = {r.icustay_id: r.urineoutput for r in c.get("urine_first_day").collect()}
    gcs = {r.icustay_id: r.mingcs for r in c.get("gcs_min").collect()}
    for r in c.get("sofa").collect():
        lab = labs.get(r.icustay_id)
        plt = lab.platelet_min if lab else None
        bili = lab.bilirubin_max if lab else None
        cr = lab.creatinine_max if lab else None
        u = uo.get(r.icustay_id)
        g = gcs.get(r.icustay_id)
        coag = (None if plt is None else 4 if plt < 20 else 3 if plt < 50 else 2 if plt < 100
                else 1 if plt < 150 else 0)
        liver = (None if bili is None else 4 if bili >= 12 else 3 if bili >= 6 else
                 2 if bili >= 2 else 1 if bili >= 1.2 else 0)
        cns = (None if g is None else 1 if 13 <= g <= 14 else 2 if 10 <= g <= 12 else
               3 if 6 <= g <= 9 else 4 if g < 6 else 0)
        if _ge(cr, 5.0) or _lt(u, 200):
            renal = 4
        elif (cr is not None and 3.5 <= cr < 5.0) or _lt(u, 500):
            renal = 3
        elif cr is not None and 2.0 <= cr < 3.5:
            renal = 2
        elif cr is not None and 1.2 <= cr < 2.0:
            renal = 1
        elif cr is None and u is None:
            renal = None
        else:
            renal = 0
        assert (r.coagulation, r.liver, r.cns, r.renal) == (coag, liver, cns, renal), r


def test_sapsii_rules_match_python(spark):
    """SAPS II components from the first-day inputs, by a direct Python reading."""
    c = Concepts(Tables(spark, SF))
    vit = {r.icustay_id: r for r in c.get("vitals_first_day").collect()}
    labs = {r.icustay_id: r for r in c.get("labs_first_day").collect()}
    uo = {r.icustay_id: r.urineoutput for r in c.get("urine_first_day").collect()}
    gcs = {r.icustay_id: r.mingcs for r in c.get("gcs_min").collect()}

    def two_sided(mn, mx, low, low_pts, high, high_pts):
        if mx is None:
            return None
        if mn < low:
            return low_pts
        if mx >= high:
            return high_pts
        return 0 if (low <= mx < high and low <= mn < high) else None

    for r in c.get("sapsii").collect():
        v, lab = vit.get(r.icustay_id), labs.get(r.icustay_id)
        hrx, hrn = (v.heartrate_max, v.heartrate_min) if v else (None, None)
        if hrx is None:
            hr = None
        elif hrn < 40:
            hr = 11
        elif hrx >= 160:
            hr = 7
        elif hrx >= 120:
            hr = 4
        elif hrn < 70:
            hr = 2
        elif 70 <= hrx < 120 and 70 <= hrn < 120:
            hr = 0
        else:
            hr = None
        tx, tn = (v.tempc_max, v.tempc_min) if v else (None, None)
        temp = None if tx is None else 0 if tn < 39.0 else 3 if tx >= 39.0 else None
        u = uo.get(r.icustay_id)
        uo_s = None if u is None else 11 if u < 500 else 4 if u < 1000 else 0
        bun = lab.bun_max if lab else None
        bun_s = None if bun is None else 0 if bun < 28 else 6 if bun < 83 else \
            10 if bun >= 84 else None
        wbc = two_sided(lab.wbc_min, lab.wbc_max, 1.0, 12, 20.0, 3) if lab else None
        k = two_sided(lab.potassium_min, lab.potassium_max, 3.0, 3, 5.0, 3) if lab else None
        na = two_sided(lab.sodium_min, lab.sodium_max, 125, 5, 145, 1) if lab else None
        g = gcs.get(r.icustay_id)
        gcs_s = (None if g is None or g < 3 else 26 if g < 6 else 13 if g < 9 else
                 7 if g < 11 else 5 if g < 14 else 0 if g <= 15 else None)
        assert (r.hr_score, r.temp_score, r.uo_score, r.bun_score, r.wbc_score,
                r.potassium_score, r.sodium_score, r.gcs_score) == \
            (hr, temp, uo_s, bun_s, wbc, k, na, gcs_s), r


def test_apsiii_rules_match_python(spark):
    """APS III components (worst of min/max, single-sided ones) by a direct reading."""
    c = Concepts(Tables(spark, SF))
    vit = {r.icustay_id: r for r in c.get("vitals_first_day").collect()}
    labs = {r.icustay_id: r for r in c.get("labs_first_day").collect()}
    uo = {r.icustay_id: r.urineoutput for r in c.get("urine_first_day").collect()}

    def band(x, edges, pts):
        if x is None:
            return None
        for e, p in zip(edges, pts):
            if x < e:
                return p
        return pts[-1]

    def worst(mn, mx, normal, edges, pts):
        if mx is None:
            return None
        smin, smax = band(mn, edges, pts), band(mx, edges, pts)
        dmx, dmn = abs(mx - normal), abs(mn - normal)
        if dmx > dmn:
            return smax
        if dmx < dmn:
            return smin
        return smax if smax >= smin else smin

    hr_b = ((40, 50, 100, 110, 120, 140, 155), (8, 5, 0, 1, 5, 7, 13, 17))
    mbp_b = ((40, 60, 70, 80, 100, 120, 130, 140), (23, 15, 7, 6, 0, 4, 7, 9, 10))
    na_b = ((120, 135, 155), (3, 2, 0, 4))
    bun_b = ((17.0, 20.0, 40.0, 80.0), (0, 2, 7, 11, 12))
    bili_b = ((2.0, 3.0, 5.0, 8.0), (0, 5, 6, 8, 16))
    uo_b = ((400, 600, 900, 1500, 2000, 4000), (15, 8, 7, 5, 4, 0, 1))
    for r in c.get("apsiii").collect():
        v, lab = vit.get(r.icustay_id), labs.get(r.icustay_id)
        hr = worst(v.heartrate_min, v.heartrate_max, 75, *hr_b) if v else None
        mbp = worst(v.meanbp_min, v.meanbp_max, 90, *mbp_b) if v else None
        na = worst(lab.sodium_min, lab.sodium_max, 145.5, *na_b) if lab else None
        bun = band(lab.bun_max, *bun_b) if lab else None
        bili = band(lab.bilirubin_max, *bili_b) if lab else None
        u = band(uo.get(r.icustay_id), *uo_b)
        assert (r.hr_score, r.meanbp_score, r.sodium_score, r.bun_score, r.bilirubin_score,
                r.uo_score) == (hr, mbp, na, bun, bili, u), r


def test_sirs_rules_match_python(spark):
    c = Concepts(Tables(spark, SF))
    vit = {r.icustay_id: r for r in c.get("vitals_first_day").collect()}
    labs = {r.icustay_id: r for r in c.get("labs_first_day").collect()}
    paco2 = defaultdict(list)
    for r in c.get("blood_gas_arterial").collect():
        if r.specimen_pred == "ART" and r.pco2 is not None:
            paco2[r.icustay_id].append(r.pco2)
    for r in c.get("sirs").collect():
        v, lab = vit.get(r.icustay_id), labs.get(r.icustay_id)
        tn, tx = (v.tempc_min, v.tempc_max) if v else (None, None)
        hrx, rrx = (v.heartrate_max, v.resprate_max) if v else (None, None)
        pc = min(paco2[r.icustay_id]) if paco2.get(r.icustay_id) else None
        wn, wx, bx = (lab.wbc_min, lab.wbc_max, lab.bands_max) if lab else (None, None, None)
        temp = 1 if (_lt(tn, 36.0) or (tx is not None and tx > 38.0)) else \
            (None if tn is None else 0)
        hr = 1 if (hrx is not None and hrx > 90.0) else (None if hrx is None else 0)
        resp = 1 if ((rrx is not None and rrx > 20.0) or _lt(pc, 32.0)) else \
            (None if rrx is None and pc is None else 0)
        wbc = 1 if (_lt(wn, 4.0) or (wx is not None and wx > 12.0)
                    or (bx is not None and bx > 10)) else \
            (None if wn is None and bx is None else 0)
        total = sum(x or 0 for x in (temp, hr, resp, wbc))
        assert (r.temp_score, r.heartrate_score, r.resp_score, r.wbc_score, r.sirs) == \
            (temp, hr, resp, wbc, total), r


def test_hemodyn_map_twm_matches_python_loop(spark):
    """Daily MAP average and time-weighted mean (weights = hours since the
    previous MAP-type row of the stay), from the MPP rows."""
    from stayframe.plans.hemodynamics import MAP_ITEMS
    c = Concepts(Tables(spark, SF))
    adm = {r.icustay_id: r.admittime for r in c.get("cohort").collect()}
    rows = defaultdict(list)
    for r in c.get("mpp_nearest").collect():
        if r.type == "MeanBP":
            rows[r.icustay_id].append(r)
    s1 = dt.timedelta(seconds=1)
    groups = defaultdict(list)
    for stay, rs in rows.items():
        rs.sort(key=lambda r: (r.charttime, r.row_id))
        for i, r in enumerate(rs):
            w = None if i == 0 else (r.charttime - rs[i - 1].charttime).total_seconds() / 3600
            delta = r.charttime - adm[stay]
            day = 1 if delta <= dt.timedelta(hours=24) else next(
                (k for k in range(2, 8)
                 if (k - 1) * dt.timedelta(hours=24) + s1 <= delta <= k * dt.timedelta(hours=24)),
                None)
            if day is not None and r.mabp is not None:
                groups[(stay, day)].append((r.mabp, w))
    want = {}
    for key, g in groups.items():
        ws = [w for _, w in g if w is not None]
        sw = sum(ws) if ws else None
        prods = [v * w for v, w in g if w is not None]
        svw = sum(prods) if prods else None
        mx = max(v for v, _ in g)
        twm = mx if (sw == 0 or svw == 0) else (svw / sw if sw is not None else None)
        want[key] = (round(sum(v for v, _ in g) / len(g), 6), None if twm is None else round(twm, 6))
    got = {(r.icustay_id, r.day): (round(r.avg_mabp, 6),
                                   None if r.twm_mabp is None else round(r.twm_mabp, 6))
           for r in c.get("hemodyn_daily").collect() if r.avg_mabp is not None}
    assert got == want and len(got) > 0
    assert all(i in MAP_ITEMS for r in rows.values() for i in [x.itemid for x in r])


def test_creat_daily_matches_python_loop(spark):
    """Daily creatinine max (µmol/L) joined by patient, 'between' day buckets."""
    c = Concepts(Tables(spark, SF))
    cohort = c.get("cohort").collect()
    labs = defaultdict(list)
    for r in c.t.labevents.where(c.t.labevents.itemid.isin(50912, 51081)).collect():
        labs[r.subject_id].append(r)
    s1, d24 = dt.timedelta(seconds=1), dt.timedelta(hours=24)
    want = defaultdict(lambda: None)
    keys = set()
    for st in cohort:
        for r in labs.get(st.subject_id, []):
            delta = r.charttime - st.admittime
            day = 1 if delta <= d24 else next(
                (k for k in range(2, 8) if (k - 1) * d24 + s1 <= delta <= k * d24), None)
            if day is None:
                continue
            keys.add((st.icustay_id, day))
            if r.valuenum is not None:
                v = r.valuenum * 88
                cur = want[(st.icustay_id, day)]
                want[(st.icustay_id, day)] = v if cur is None else max(cur, v)
    want = {k: None if want[k] is None else round(want[k], 6) for k in keys}
    got = {(r.icustay_id, r.day): None if r.creat is None else round(r.creat, 6)
           for r in c.get("creat_daily").collect()}
    assert got == want and len(got) > 0


def test_rrt_daily_matches_python_loop(spark):
    from stayframe.plans import renal as rn
    c = Concepts(Tables(spark, SF))
    cohort = c.get("cohort").collect()
    ce = defaultdict(list)
    for r in c.t.chartevents.where(c.t.chartevents.itemid.isin(*rn.RRT_SCAN_ITEMS)).collect():
        ce[r.subject_id].append(r)
    s1, d24 = dt.timedelta(seconds=1), dt.timedelta(hours=24)
    want = {}
    for st in cohort:
        for r in ce.get(st.subject_id, []):
            delta = r.charttime - st.admittime
            day = 1 if delta <= d24 else next(
                (k for k in range(2, 8) if (k - 1) * d24 + s1 <= delta <= k * d24), None)
            if day is None:
                continue
            flag = int((r.itemid in rn.RRT_FLAG_ITEMS and r.value is not None)
                       or (r.itemid in rn.RRT_LINE_ITEMS and r.value == "Dialysis Line")
                       or (r.itemid == 582 and r.value in rn.RRT_PROCEDURE_VALUES))
            key = (st.icustay_id, day)
            want[key] = max(want.get(key, 0), flag)
    got = {(r.icustay_id, r.day): r.rrt for r in c.get("rrt_daily").collect()}
    assert got == want and len(got) > 0


def test_vasopressor_days_match_python_loop(spark):
    from stayframe.plans.daily import VASOPRESSORS
    c = Concepts(Tables(spark, SF))
    adm = {r.icustay_id: r.admittime for r in c.get("cohort").collect()}
    items = {i: name for name, (ids, _) in VASOPRESSORS.items() for i in ids}
    s1, d24 = dt.timedelta(seconds=1), dt.timedelta(hours=24)
    want = set()
    for r in c.t.inputevents_cv.where(c.t.inputevents_cv.itemid.isin(*items)).collect():
        if r.icustay_id not in adm:
            continue
        drug = items[r.itemid]
        delta = r.charttime - adm[r.icustay_id]
        first = d24 + (s1 if drug == "vasopressine" else dt.timedelta(0))
        day = 1 if delta <= first else next(
            (k for k in range(2, 8) if (k - 1) * d24 + s1 <= delta <= k * d24), None)
        if day is not None:
            want.add((drug, r.icustay_id, day))
    got = {(r.drug, r.icustay_id, r.day) for r in c.get("vasopressor_daily").collect()}
    assert got == want and len(got) > 0
