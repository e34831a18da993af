"""The registered queries in plain SQL, written independently of the Spark operators."""

from __future__ import annotations

import re

BASE: dict[str, str] = {
    "a": "select distinct cast(substr(p_brand,7) as int) article_id from part",
    "b": "select cast(n_nationkey as int) branch_id from nation",
    "v": "select cast(unnest([0,1]) as int) ver",
    "catalog": """
        select article_id, 41 branch_id, article_id*10 supplier_id,
          case when article_id%10=0 then 0 else 1 end active_for_purchase,
          cast(null as varchar) route_code, 0 supply_mode, 1 enabled, 1 active_for_sale,
          1 active_on_mix, timestamp '2001-08-01 03:00:00' extracted_at
        from a
        union all
        select article_id, 41, article_id*10-5, case when article_id%10=0 then 0 else 1 end, null, 0, 1, 1, 1,
          timestamp '2001-07-01 03:00:00' from a where article_id%3=0
        union all
        select article_id, branch_id,
          case when (article_id+branch_id)%5=0 then null else article_id*10+1+ver end, 1,
          case when (article_id+branch_id)%7=0 then 'DIRECT' else '41CD' end,
          case when (article_id*3+branch_id)%11=0 then 1 else 0 end,
          case when (article_id+2*branch_id)%13=0 then 0 else 1 end, 1,
          case when (article_id*branch_id)%17=1 then 0 else 1 end,
          case when ver=0 then timestamp '2001-08-01 03:00:00' end
        from a cross join b cross join v""",
    "later": """
        select article_id, branch_id,
          case when branch_id<>41 and (article_id+branch_id)%23=0 then 7 else supplier_id end supplier_id,
          active_for_purchase,
          case when branch_id<>41 and (article_id+branch_id)%21=0 then '41CD' else route_code end route_code,
          supply_mode,
          case when branch_id<>41 and (article_id+branch_id)%19=0 then 0 else enabled end enabled,
          active_for_sale, active_on_mix, extracted_at
        from catalog""",
    "origin": """
        select article_id, max_by(supplier_id, extracted_at) s from catalog
        where branch_id=41 and active_for_purchase=1 group by 1""",
    "pairs": """
        select c.article_id, c.branch_id, coalesce(c.supplier_id, o.s) supplier_id
        from catalog c join origin o using (article_id)
        where route_code='41CD' and supply_mode=0 and enabled=1 and active_for_sale=1
          and active_on_mix=1 and branch_id<>41
        qualify row_number() over (partition by c.branch_id, c.article_id
          order by extracted_at desc nulls last)=1""",
    "later_pairs": """
        select c.article_id, c.branch_id, coalesce(c.supplier_id, o.s) supplier_id
        from later c join origin o using (article_id)
        where route_code='41CD' and supply_mode=0 and enabled=1 and active_for_sale=1
          and active_on_mix=1 and branch_id<>41
        qualify row_number() over (partition by c.branch_id, c.article_id
          order by extracted_at desc nulls last)=1""",
    "sscope": "select article_id, branch_id from pairs union select article_id, 41 from origin",
    "hist": "select min(l_shipdate)::date lo, max(l_shipdate)::date hi from lineitem",
    "cal": "select unnest(generate_series(lo, hi, interval 1 day))::date d from hist",
    "raw": """
        select l_shipdate ts, cast(l_shipdate as date) sales_date,
          cast(substr(p_brand,7) as int) article_id, cast(s_nationkey as int) branch_id,
          cast(((cast(round(l_extendedprice*100) as bigint)*20000 + cast(l_quantity as bigint))
            // (2*cast(l_quantity as bigint)))/1e6 as decimal(18,6)) price,
          cast(case when l_returnflag='R' and l_linestatus='F' then -l_quantity else l_quantity end
            as decimal(18,6)) units,
          cast(l_extendedprice as decimal(20,4)) amount, l_orderkey%50=0 special_sale,
          l_discount>=0.08 normal_promo, l_discount>=0.1 strong_promo,
          cast(substr(p_brand,7) as int)%5 family_id, p_size category_id,
          cast(substr(p_brand,7) as int)*10 supplier_id
        from lineitem join part on p_partkey=l_partkey join supplier on s_suppkey=l_suppkey""",
    "enr": """
        select sales_date, article_id, branch_id, price, units,
          cast(case when normal_promo then floor(greatest(units,0)*0.5) else greatest(units,0) end
            as decimal(18,6)) basal,
          cast(case when normal_promo then greatest(units,0)-floor(greatest(units,0)*0.5) else 0 end
            as decimal(18,6)) promo,
          case when strong_promo then 100 when normal_promo then 70 else 0 end score,
          strong_promo strong
        from raw where month(sales_date)%2=0 or article_id%3=0""",
    "raw_daily": """
        select sales_date, article_id, branch_id, count(*) n,
          cast(sum(greatest(units,0)) as decimal(18,6)) observed,
          cast(sum(abs(least(units,0))) as decimal(18,6)) returned,
          cast(sum(amount) as decimal(20,4)) amount,
          ((2*sum(case when units>0 then cast(price*1000000 as bigint)*cast(units as bigint) end)
              + sum(cast(greatest(units,0) as bigint)))
            // nullif(2*sum(cast(greatest(units,0) as bigint)),0))/1e6 eff,
          min(price) min_price, max(price) max_price, bool_or(special_sale) f1,
          bool_or(normal_promo) f2, bool_or(strong_promo) f3, max(family_id) family_id,
          max(category_id) category_id, max(supplier_id) supplier_id
        from raw group by all""",
    "enr_daily": """
        select sales_date, article_id, branch_id, count(*) n,
          cast(sum(greatest(basal,0)) as decimal(18,6)) basal,
          cast(sum(greatest(promo,0)) as decimal(18,6)) promo, max(score) score,
          bool_or(strong) strong
        from enr group by all""",
    "allpairs": "select distinct article_id, branch_id from catalog",
    "sdays": """
        select m, unnest(generate_series(m, last_day(m), interval 1 day))::date d from (
          select unnest(generate_series(date_trunc('month',lo), date_trunc('month',hi),
            interval 1 month))::date m from hist)""",
    "stock_all": """
        select d stock_date, article_id, branch_id,
          cast((article_id*7+branch_id*13+day(d)*3+month(d)*5)%11-2 as decimal(18,6)) q,
          case when year(d)=2001 and month(d)=8 then timestamp '2001-08-02 04:00:00' end done
        from allpairs cross join sdays
        where not ((article_id+branch_id)%6=0 and year(d)=2001 and month(d) in (7,8))""",
    "stock": """
        select s.*, sha256(concat_ws('|', stock_date::varchar, article_id::varchar,
          branch_id::varchar, q::varchar, coalesce(done::varchar,''), 'true', 'LEGACY')) h
        from stock_all s join sscope using (article_id, branch_id)
        where (done is null or stock_date<=cast(done as date)-1)
          and stock_date between (select lo from hist) and (select hi from hist)""",
    "hp0": """
        select c.d sales_date, p.article_id, p.branch_id,
          coalesce(r.supplier_id, p.supplier_id) supplier_id, r.family_id, r.category_id,
          coalesce(r.n,0) source_row_count,
          cast(coalesce(r.observed,0) as decimal(18,6)) observed,
          cast(coalesce(r.returned,0) as decimal(18,6)) returned, r.amount, r.eff,
          coalesce(f1,false) f1, coalesce(f2,false) f2, coalesce(f3,false) f3,
          coalesce(e.n,0)>0 enriched, e.basal e_basal, e.promo e_promo, e.score,
          coalesce(e.strong,false) strong, s.q, s.h
        from pairs p cross join cal c
        left join raw_daily r on r.sales_date=c.d and r.article_id=p.article_id and r.branch_id=p.branch_id
        left join enr_daily e on e.sales_date=c.d and e.article_id=p.article_id and e.branch_id=p.branch_id
        left join stock s on s.stock_date=c.d and s.article_id=p.article_id and s.branch_id=p.branch_id""",
    "hp1": """
        select *, source_row_count>0 and (f1 or f2 or f3) flagged,
          case when observed>0 then 'INFERRED_FROM_SALE' when h is null then 'UNKNOWN'
            when q>0 then 'IN_STOCK' else 'OUT_OF_STOCK' end availability
        from hp0""",
    "hp2": """
        select *,
          cast(case when enriched then e_basal when flagged then 0 else observed end as decimal(18,6)) basal,
          cast(case when enriched then e_promo when flagged then observed else 0 end as decimal(18,6)) promo,
          case when enriched then 'ENRICHED' when flagged then 'RAW_FLAGS'
            when source_row_count>0 then 'NO_ADJUSTMENT' else 'NOT_APPLICABLE' end method
        from hp1""",
    "hpanel": """
        select *,
          availability in ('IN_STOCK','INFERRED_FROM_SALE')
            and not (method='RAW_FLAGS' and observed>0) eligible,
          concat_ws(',', case when availability='UNKNOWN' then 'STOCK_UNKNOWN' end,
            case when availability='OUT_OF_STOCK' then 'OUT_OF_STOCK' end,
            case when method='RAW_FLAGS' and observed>0 then 'PROMO_WITHOUT_ENRICHMENT' end) codes,
          sha256(concat_ws('|', sales_date::varchar, article_id::varchar, branch_id::varchar,
            observed::varchar, returned::varchar, basal::varchar, promo::varchar, availability,
            method, coalesce(h,''))) hash
        from hp2""",
    "bd": "select date '2001-08-02' t",
    "alldates": """
        select cast(lo + cast(394 + n as int) as date) t
        from hist, unnest(generate_series(0, hi - lo - 394 - 1)) g(n)""",
    "trail": """
        select sales_date, article_id, branch_id, count(*) over w c, count(*) filter (eligible) over w el,
          sum(basal) filter (eligible) over w basal, sum(observed) filter (eligible) over w observed,
          sum(observed) over w every_unit
        from hpanel window w as (partition by article_id, branch_id order by sales_date
          rows between 27 preceding and current row)""",
    "prior": "select date '2001-07-05' t",
}


def _evidence(prefix: str, dates: str, units: str) -> dict:
    """Evidence of every pair and date from the days of its windows."""
    return {
        f"{prefix}_w": f"""
            select t, 'r' role, t-28 s, t-1 e from {dates}
            union all select t, 'p', t-56, t-29 from {dates}
            union all select t, 's', cast(t-1-interval 1 year as date)-27,
              cast(t-1-interval 1 year as date) from {dates}""",
        f"{prefix}_j": f"""
            select w.t, w.role, h.*, h.{units} u, h.eligible and h.{units}>0 nz
            from (select t, role, unnest(generate_series(s, e, interval 1 day))::date at_day from {prefix}_w) w
            join hpanel h on h.sales_date = w.at_day""",
        f"{prefix}_a": f"""
            select t, article_id, branch_id, count(*) active_days,
              count(*) filter (eligible) eligible_days, count(*) filter (nz) nonzero_days,
              count(*) filter (eligible and (source_row_count=0 or method='ENRICHED')) reliable,
              sum(u::double) filter (nz) sx, sum(u::double*u::double) filter (nz) sxx,
              count(*) filter (role='r') r_act, count(*) filter (role='p') p_act,
              count(*) filter (role='s') s_act,
              count(*) filter (role='r' and eligible) r_el,
              count(*) filter (role='p' and eligible) p_el,
              count(*) filter (role='s' and eligible) s_el,
              sum(u) filter (role='r' and eligible) r_u, sum(u) filter (role='p' and eligible) p_u,
              sum(u) filter (role='s' and eligible) s_u,
              string_agg(hash, '' order by sales_date) hashes
            from {prefix}_j group by all""",
    }


def _estimate(
    prefix: str, dates: str, weights=("0.60", "0.25", "0.15"), units: str = "basal", trailing: bool = False
) -> dict:
    """Common table expressions that estimate every pair on every date of `dates`, from the days of
    the windows or, where no hashes are asked for, from trailing 28-day sums at their ends."""
    r, p, s = weights
    if trailing:
        evidence = {
            f"{prefix}_a": f"""
            select d.t, p.article_id, p.branch_id,
              coalesce(r.c,0)+coalesce(q.c,0)+coalesce(s.c,0) active_days,
              coalesce(r.el,0)+coalesce(q.el,0)+coalesce(s.el,0) eligible_days,
              r.el r_el, q.el p_el, s.el s_el, r.{units} r_u, q.{units} p_u, s.{units} s_u, '' hashes
            from {dates} d cross join pairs p
            left join trail r on r.sales_date=d.t-1 and r.article_id=p.article_id and r.branch_id=p.branch_id
            left join trail q on q.sales_date=d.t-29 and q.article_id=p.article_id and q.branch_id=p.branch_id
            left join trail s on s.sales_date=cast(d.t-1-interval 1 year as date)
              and s.article_id=p.article_id and s.branch_id=p.branch_id"""
        }
    else:
        evidence = _evidence(prefix, dates, units)
    gate = "coalesce(r_el,0) < 7 or coalesce(r_el,0)+coalesce(p_el,0)+coalesce(s_el,0) < 14 or avail = 0"
    return evidence | {
        f"{prefix}_s": f"""
            select d.t, p.article_id, p.branch_id, p.supplier_id,
              x.* exclude (t, article_id, branch_id),
              cast(r_u::double/nullif(r_el,0) as decimal(18,6)) r_mean,
              cast(p_u::double/nullif(p_el,0) as decimal(18,6)) p_mean,
              cast(s_u::double/nullif(s_el,0) as decimal(18,6)) s_mean,
              case when r_el>0 then {r} else 0 end + case when p_el>0 then {p} else 0 end
                + case when s_el>0 then {s} else 0 end avail
            from pairs p cross join {dates} d left join {prefix}_a x
              on x.t=d.t and x.article_id=p.article_id and x.branch_id=p.branch_id""",
        f"{prefix}_g": f"""
            select *, {gate} blocked,
              cast(case when {gate} or coalesce(r_el,0)=0 then 0 else {r}::double/avail::double end as decimal(8,6)) r_w,
              cast(case when {gate} or coalesce(p_el,0)=0 then 0 else {p}::double/avail::double end as decimal(8,6)) p_w,
              cast(case when {gate} or coalesce(s_el,0)=0 then 0 else {s}::double/avail::double end as decimal(8,6)) s_w,
              case when active_days>0 then eligible_days::double/active_days else 0 end cover
            from {prefix}_s""",
        f"{prefix}_e": f"""
            select *, case when not blocked then cast(coalesce(r_mean,0)*r_w + coalesce(p_mean,0)*p_w
                + coalesce(s_mean,0)*s_w as decimal(18,6)) end value
            from {prefix}_g""",
        prefix: f"""
            select *,
              case when blocked then 'BLOCKED' when value=0 then 'ZERO_VALID'
                when cover<0.7 or coalesce(p_el,0)=0 or coalesce(s_el,0)=0 then 'WARN' else 'OK' end status,
              case when blocked then 'INSUFFICIENT_DATA'
                when coalesce(p_el,0)=0 and coalesce(s_el,0)=0 then 'SKU_BRANCH_RECENT'
                else 'SKU_BRANCH_WEIGHTED' end method_code,
              cast(case when blocked then 9 when coalesce(p_el,0)=0 and coalesce(s_el,0)=0 then 2
                when coalesce(s_el,0)=0 then 1 else 0 end as int) fallback,
              sha256(concat_ws('|','scope-1',article_id::varchar,branch_id::varchar,t::varchar,
                coalesce(hashes,''))) checksum
            from {prefix}_e""",
    }


BASE |= _estimate("est", "bd")
BASE |= _estimate("pest", "prior")
BASE |= _estimate("aest", "alldates", trailing=True)
BASE |= _estimate("v_recent", "alldates", ("1", "0", "0"), trailing=True)
BASE |= _estimate("v_other", "alldates", ("0.8", "0.1", "0.2"), trailing=True)
BASE |= _estimate("v_plain", "alldates", units="observed", trailing=True)

BASE |= {
    "daily": """
        select article_id, branch_id, c, hs || coalesce(lead(hs) over (partition by article_id, branch_id
          order by c), []) hs
        from (select article_id, branch_id, ((sales_date-lo)//64)::int c, list(hash order by sales_date) hs
          from hpanel, hist group by all)""",
    "dayed": """
        select t, (t-56-lo)::int r, (cast(t-1-interval 1 year as date)-27-lo)::int s from alldates, hist""",
    "inputs": """
        select t, article_id, branch_id, sha256(concat_ws('|', 'scope-1', article_id::varchar,
          branch_id::varchar, t::varchar,
          array_to_string(x.hs[s%64+1:s%64+28] || y.hs[r%64+1:r%64+56], ''))) checksum
        from dayed d join daily x on x.c=s//64 join daily y using (article_id, branch_id)
        where y.c=r//64""",
    "bt": """
        select e.t+1 evaluation_date, e.t origin_date, e.article_id, e.branch_id, e.value predicted,
          cast(coalesce(h.basal,0) as decimal(18,6)) actual, coalesce(h.eligible,false) ok,
          cast(coalesce(h.basal,0)-e.value as decimal(18,6)) err,
          sha256(concat_ws('|', i.checksum, coalesce(h.hash,''), (e.t+1)::varchar, '1')) checksum
        from aest e join inputs i using (t, article_id, branch_id)
        left join hpanel h on h.sales_date=e.t+1 and h.article_id=e.article_id
          and h.branch_id=e.branch_id
        where e.status<>'BLOCKED'""",
    "mean28": """
        select d.t, h.article_id, h.branch_id, cast(h.every_unit::double/h.c as decimal(18,6)) predicted
        from alldates d join trail h on h.sales_date=d.t-1""",
    "together": """
        select m.t, m.article_id, m.branch_id, m.predicted m, e.value e, r.value r, o.value o, n.value n
        from mean28 m join aest e using (t, article_id, branch_id)
        join v_recent r using (t, article_id, branch_id)
        join v_other o using (t, article_id, branch_id)
        join v_plain n using (t, article_id, branch_id)
        where e.value is not null and r.value is not null and o.value is not null
          and n.value is not null""",
    "cases": """
        select t, article_id, branch_id, 'MEAN_28' variant, m predicted from together
        union all select t, article_id, branch_id, 'ESTIMATE', e from together
        union all select t, article_id, branch_id, 'RECENT_ONLY', r from together
        union all select t, article_id, branch_id, 'OTHER_WEIGHTS', o from together
        union all select t, article_id, branch_id, 'NO_PROMO_ADJUSTMENT', n from together""",
    "scored": """
        select c.variant, c.branch_id, cast(h.basal-c.predicted as decimal(18,6)) err, h.basal actual
        from cases c join hpanel h on h.sales_date=c.t+1 and h.article_id=c.article_id
          and h.branch_id=c.branch_id where h.eligible""",
    "med": """
        select date_trunc('month',sales_date)::date m, article_id, branch_id,
          round(median(cast(units*1000000 as bigint)),0)/1e6 mu,
          round(median(cast(price*1000000 as bigint)),0)/1e6 mp, count(*) n
        from raw group by all""",
    "psplit": """
        select r.*, case
            when price<=mp*0.80 and units>=mu*2.0 then 100
            when price<=mp*0.90 and units>=mu*1.5 then 70
            when price<=mp*0.95 and units>=mu*1.2 then 40 else 0 end score, mu
        from (select article_id, branch_id, sales_date, cast(price as decimal(18,6)) price, units from raw) r
        join (select m, article_id, branch_id, cast(mu as decimal(18,6)) mu,
            cast(mp as decimal(18,6)) mp from med) b
          on b.m=date_trunc('month',r.sales_date) and b.article_id=r.article_id
            and b.branch_id=r.branch_id""",
    "params": """
        select article_id, cast(null as int) branch_id, 2 lt, 7 ts, 3 os, date '1995-01-01' vf,
          cast(null as date) vt from a where article_id<>13
        union all
        select article_id, branch_id, 1+branch_id%3, 7+article_id%3, 3, date '2000-01-01',
          case when (article_id+branch_id)%8=0 then date '2001-06-30' end
        from a cross join b where (article_id+branch_id)%2=0""",
    "pos0": """
        select p.article_id, p.branch_id, p.supplier_id, s.q*5 physical,
          cast(p.article_id%4 as decimal(18,6)) inbound, cast(p.branch_id%3 as decimal(18,6)) transit,
          cast(p.article_id%2 as decimal(18,6)) committed, e.value demand, e.status est_status,
          coalesce(x.lt,w.lt) lt, coalesce(x.ts,w.ts) ts, coalesce(x.os,w.os) os
        from pairs p
        left join stock s on s.stock_date=date '2001-08-01' and s.article_id=p.article_id
          and s.branch_id=p.branch_id
        join est e on e.article_id=p.article_id and e.branch_id=p.branch_id
        left join params x on x.article_id=p.article_id and x.branch_id=p.branch_id
          and date '2001-08-02' between x.vf and coalesce(x.vt, date '9999-12-31')
        left join params w on w.article_id=p.article_id and w.branch_id is null
          and date '2001-08-02' between w.vf and coalesce(w.vt, date '9999-12-31')""",
    "pos": """
        select *, physical+inbound+transit-committed net, cast(demand*lt as decimal(18,6)) crit,
          cast(demand*lt*2 as decimal(18,6)) mn, cast(demand*ts as decimal(18,6)) mx,
          cast(demand*os as decimal(18,6)) ov,
          case when demand is null or physical is null or lt is null then 'BLOCKED'
            when demand=0 then 'ZERO_PDVB' when est_status='WARN' then 'WARN' else 'OK' end status,
          concat_ws(',', case when demand is null then 'MISSING_DEMAND' end,
            case when lt is null then 'MISSING_PARAMETERS' end,
            case when physical is null then 'MISSING_STOCK' end) alerts
        from pos0""",
    "pos2": """
        select *, (physical+inbound+transit-committed)::double/nullif(demand,0)::double cover,
          case when status='ZERO_PDVB' then 0 when status<>'BLOCKED' then greatest(mx-net,0) end dq
        from pos""",
    "pos3": """
        select *, case when status='ZERO_PDVB' then 0
            when status<>'BLOCKED' then greatest(mx+ov-greatest(net,0)-dq,0) end sq,
          cast(case when status in ('BLOCKED','ZERO_PDVB') then null when net<=0 then 100
            when cover<lt then 90 when cover<=2*lt then 50 when cover<ts then 25 else 0 end as int) risk
        from pos2""",
    "items": """
        select cast(substr(p_brand,7) as int) article_id, max(p_size) size from part group by 1""",
    "logi": """
        select article_id, case when article_id%6<>5 then 4+article_id%5 end upp,
          case when article_id%7<>6 then 10+article_id%4 end ppp, size/10 kg,
          case when article_id<>24 then size/1000 end m3 from items""",
    "logi2": """
        select *, case when upp is not null and ppp is not null and m3 is not null then 'COMPLETE'
          else 'PARTIAL' end quality from logi""",
    "needs": """
        select x.*, l.upp, case when x.q is null then null when upp is null then x.q::double
            else ceil(x.q::double/upp)*upp end rounded
        from (
          select article_id, branch_id, supplier_id, status pstat, risk, 'D' nt, true mand, dq q from pos3
          union all
          select article_id, branch_id, supplier_id, status, risk, 'S', false, sq from pos3
        ) x left join logi l using (article_id)""",
    "opened": """
        select n.*, case when n.pstat<>'BLOCKED' then greatest(n.rounded - case when n.nt='D'
            then (n.article_id+n.branch_id)%4
            else greatest((n.article_id+n.branch_id)%4-coalesce(d.rounded,0),0) end, 0) end open
        from needs n join needs d on d.nt='D' and d.article_id=n.article_id and d.branch_id=n.branch_id""",
    "dn0": """
        select l_orderkey k, cast(substr(p_brand,7) as int) article_id,
          cast(s_nationkey as int) branch_id, sum(l_quantity) qty
        from lineitem join part on p_partkey=l_partkey join supplier on s_suppkey=l_suppkey
        group by all""",
    "dn1": """
        select k, article_id, branch_id, qty,
          case o_orderpriority when '1-URGENT' then 'E' when '2-HIGH' then 'C' else 'A' end nt,
          o_orderdate::date vf,
          case when o_orderstatus='F' then qty when o_orderstatus='P' then floor(qty*0.5) else 0 end prep
        from dn0 join orders on o_orderkey=k
        where o_orderpriority in ('1-URGENT','2-HIGH','3-MEDIUM')""",
    "dn": """
        select *, k||'-'||article_id||'-'||branch_id line_id, 'REF-'||(k%100) ref,
          case nt when 'E' then vf+2000 when 'C' then vf+400 end vt, vf+10 target,
          case when k%20=0 then qty-prep else 0 end canc,
          greatest(qty-prep-case when k%20=0 then qty-prep else 0 end,0) open
        from dn1""",
    "src": """
        select 41 origin_id, branch_id, article_id, supplier_id, nt,
          nt||'-'||article_id||'-'||branch_id source_id, open, date '2001-08-02' nd,
          cast(null as date) target, risk
        from opened where open>0
        union all
        select 41, d.branch_id, d.article_id, p.supplier_id, d.nt, line_id, open, vf, target, null
        from dn d left join pairs p on p.article_id=d.article_id and p.branch_id=d.branch_id
        where open>0 and vf<=date '2001-08-02' and coalesce(vt, date '9999-12-31')>=date '2001-08-02'""",
    "lexec": """
        select article_id, branch_id, (article_id*3+branch_id)%40 imported,
          case when article_id%3=0 then (article_id*3+branch_id)%40
            when article_id%3=1 then (article_id+branch_id)%10 else 0 end prepared
        from pairs""",
    "ln0": """
        select origin_id, branch_id, article_id, coalesce(supplier_id,-1) sk,
          coalesce(sum(open) filter (nt='D'),0) dq, coalesce(sum(open) filter (nt='E'),0) eq,
          coalesce(sum(open) filter (nt='C'),0) cq, coalesce(sum(open) filter (nt='A'),0) aq,
          coalesce(sum(open) filter (nt='S'),0) sq, max(risk) risk, min(nd) oldest,
          min(target) target, min(target) filter (nt in ('E','C')) commit_date, count(*) n
        from src group by all""",
    "ln": """
        select n.*, dq+eq+cq mand, aq+sq opt, dq+eq+cq+aq+sq total,
          coalesce(x.imported,0) imported, coalesce(x.prepared,0) prepared,
          case when p.article_id is not null then n.branch_id%3 else 0 end transit,
          coalesce(l.quality,'MISSING') quality, upp, ppp, kg, m3,
          n.origin_id||'-'||n.branch_id||'-'||n.article_id||'-'||sk line_id,
          case when datediff('day', date '2001-08-02', commit_date)<0 then 1
            when datediff('day', date '2001-08-02', commit_date)<=3 then 2 else 3 end pclass
        from ln0 n
        left join lexec x on x.article_id=n.article_id and x.branch_id=n.branch_id
        left join pairs p on p.article_id=n.article_id and p.branch_id=n.branch_id
        left join logi2 l on l.article_id=n.article_id""",
    "rk": """
        select *, row_number() over (partition by origin_id order by pclass, risk desc nulls last,
          oldest nulls last, target nulls last, branch_id, article_id, sk) rnk from ln""",
    "found": """
        select *, row_number() over (order by rnk) pos from rk
        where (dq>0 or cq>0) and mand>0 and quality='COMPLETE'""",
    "ev": """
        select 'EV-'||event_id k, user_id::varchar line_id, user_id,
          case when event_type='view' then 'IMPORTED' when event_type='purchase' then 'PREPARED'
            when event_type='click' and user_id%5=0 then 'CANCELLED'
            when event_type='click' and user_id%5=1 then 'DISPATCHED' else 'UNKNOWN' end et,
          case when event_type='view' then 'GEN' when event_type='click' and user_id%5=0 then 'ANU'
            when event_type='click' and user_id%5=1 then 'EXP' when event_type='click' then 'ACO'
            when event_type='signup' then 'AGR' when event_type='purchase' then 'TER' else 'ZZZ' end ext,
          case when event_type='view' then 'IMPORTED' when event_type='click' and user_id%5=0 then 'CANCELLED'
            when event_type='click' and user_id%5=1 then 'DISPATCHED' when event_type='click' then 'IN_PROCESS'
            when event_type='signup' then 'GROUPED' when event_type='purchase' then 'PREPARED' else 'UNKNOWN' end norm,
          case when user_id%2=0 then 'CUMULATIVE' else 'DELTA' end qm,
          cast(value as decimal(18,6)) q, ts
        from events""",
    "fold": f"""
        select line_id, user_id, {', '.join(
            f"coalesce(sum(q) filter (et='{kind}' and qm='DELTA'),0)"
            f" + coalesce(max(q) filter (et='{kind}' and qm='CUMULATIVE'),0) {kind.lower()}"
            for kind in ("IMPORTED", "PREPARED", "DISPATCHED", "CANCELLED"))},
          arg_max(norm, (ts, k)) last_status, max(ts) last_ts, count(*) n,
          count(*) filter (norm='UNKNOWN') unknown_n
        from ev group by all""",
    "evd": """
        select *, max(case when qm='CUMULATIVE' then q end) over (partition by line_id, et
          order by ts, k rows between unbounded preceding and 1 preceding) hi from ev""",
    "req": """
        select 'K-'||user_id||'-'||strftime(ts,'%Y%m%d') k, user_id, user_id::varchar line_id, ts,
          cast(1+user_id%3-case when user_id%11=0 then 1 else 0 end as int) ver,
          case when user_id%13=0 then cast(value as decimal(18,6))+1000 else floor(value) end q
        from events where event_type='view'""",
}


# The backlog of a day that is closed from its events: other quantities of execution, same rules.
BASE |= {
    "lexec_day": """
        select article_id, branch_id, sum(imported) imported, sum(prepared) prepared from (
          select cast(user_id%25+1 as int) article_id, cast((user_id//25)%25 as int) branch_id, imported,
            case when prepared>imported then 0 else prepared end prepared
          from fold where user_id%17<>0) group by 1, 2""",
    "opened_day": """
        select n.*, case when n.pstat<>'BLOCKED' then greatest(n.rounded - case when n.nt='D'
            then coalesce(x.prepared,0)
            else greatest(coalesce(x.prepared,0)-coalesce(d.rounded,0),0) end, 0) end open
        from needs n join needs d on d.nt='D' and d.article_id=n.article_id and d.branch_id=n.branch_id
        left join lexec_day x on x.article_id=n.article_id and x.branch_id=n.branch_id""",
}
BASE |= {
    f"{name}_day": re.sub(r"\b(opened|lexec|src|ln0|ln)\b", r"\1_day", BASE[name])
    for name in ("src", "ln0", "ln", "rk")
}


def _r(expression: str, name: str, places: int = 6) -> str:
    return f"round(({expression})::double, {places}) as {name}"


def _checksum(expression: str) -> str:
    return f"sum(cast('0x'||substr(md5({expression}),1,15) as bigint)::hugeint)::varchar"


ERRORS = f"""count(*) cases, {_r('sum(predicted)','predicted_demand')}, {_r('sum(actual)','actual_basal_units')},
    {_r('sum(err)','error_units')}, {_r('sum(abs(err))','absolute_error_units')},
    round(sum(cast(err*err as decimal(24,8)))::double,8) squared_error"""

STATE = f"""line_id, {_r('imported', 'imported_quantity', 3)}, {_r('prepared', 'prepared_quantity', 3)},
    {_r('dispatched', 'dispatched_quantity', 3)}, {_r('cancelled', 'cancelled_quantity', 3)}, last_status,
    last_ts::date last_day, n event_count, unknown_n unknown_events"""

METRICS = """
    select {by} segment_type, segment_id, 'MAE' metric_code, {mae} metric_value, n sample_size, z zero_actual_count from {source}
    union all select {by} segment_type, segment_id, 'WAPE', {wape}, n, z from {source} where act<>0
    union all select {by} segment_type, segment_id, 'BIAS', {bias}, n, z from {source}
    union all select {by} segment_type, segment_id, 'RMSE', {rmse}, n, z from {source}"""


def _metrics(by: str, source: str) -> str:
    return METRICS.format(
        by=by, source=source, mae="round(ae::double/n,6)", wape="round(ae::double/act::double,6)",
        bias="round(e::double/n,6)", rmse="round(sqrt(se/n),6)",
    )


SUMS = """count(*) n, count(*) filter (actual=0) z, sum(err) e, sum(abs(err)) ae,
    sum(err::double*err::double) se, sum(actual) act"""

QUERIES: dict[str, str] = {
    "scope_pairs": "select * from pairs",
    "stock_scope": "select * from sscope",
    "scope_manifest": """
        with ag as (
          select ('0x'||substr(md5(article_id::varchar),1,4))::int % 4096 part,
            sha256(string_agg(concat_ws('|', article_id, article_id*10, 1, 1, 1, 1), chr(10) order by article_id)) d
          from origin group by 1),
        pg as (
          select ('0x'||substr(md5(branch_id||'|'||article_id),1,4))::int % 4096 part,
            sha256(string_agg(concat_ws('|', branch_id, article_id, coalesce(supplier_id::varchar,''), '41CD', 0, 1, 1, 1),
              chr(10) order by branch_id, article_id)) d
          from pairs group by 1),
        ac as (select sha256(string_agg(d, chr(10) order by part)) ac from ag),
        pc as (select sha256(string_agg(d, chr(10) order by part)) pc from pg)
        select (select count(*) from origin) article_count, count(*) pair_count,
          count(distinct branch_id) destination_count, count(distinct article_id) routed_article_count,
          '2001-08-01 03:00:00' source_as_of_ts, ac article_checksum, pc pair_checksum,
          sha256('articles:'||ac||'|pairs:'||pc) scope_checksum
        from pairs, ac, pc group by ac, pc""",
    "scope_snapshot": """
        select branch_id, article_id, supplier_id, '41CD' route_code, 0 supply_mode, true enabled,
          true active_for_sale, true active_on_mix from pairs""",
    "scope_diff": """
        select coalesce(o.article_id,n.article_id) article_id, coalesce(o.branch_id,n.branch_id) branch_id,
          o.supplier_id old_supplier, n.supplier_id new_supplier,
          case when o.article_id is null then 'ADDED' when n.article_id is null then 'REMOVED'
            when o.supplier_id is distinct from n.supplier_id then 'CHANGED' else 'SAME' end change
        from pairs o full join later_pairs n on n.article_id=o.article_id and n.branch_id=o.branch_id""",
    "scope_variation": """
        select change, count(*) pairs, count(distinct article_id) articles,
          count(distinct branch_id) branches from (
          select coalesce(o.article_id,n.article_id) article_id, coalesce(o.branch_id,n.branch_id) branch_id,
            case when o.article_id is null then 'ADDED' when n.article_id is null then 'REMOVED'
              when o.supplier_id is distinct from n.supplier_id then 'CHANGED' else 'SAME' end change
          from pairs o full join later_pairs n on n.article_id=o.article_id and n.branch_id=o.branch_id)
        group by 1""",
    "scope_gate": """
        select *, round((added+removed)::double/(removed+changed+same),6) variation,
          (added+removed)::double/(removed+changed+same)<=0.1 passes from (
          select count(*) filter (o.article_id is null) added,
            count(*) filter (n.article_id is null) removed,
            count(*) filter (o.article_id is not null and n.article_id is not null and o.supplier_id is distinct from n.supplier_id) changed,
            count(*) filter (o.article_id is not null and n.article_id is not null and o.supplier_id is not distinct from n.supplier_id) same
          from pairs o full join later_pairs n on n.article_id=o.article_id and n.branch_id=o.branch_id)""",
    "stock_unpivot": f"""
        select article_id, branch_id, count(*) "days", {_r('sum(q)', 'quantity')},
          min(stock_date) first_day, max(stock_date) last_day
        from stock_all where stock_date between (select lo from hist) and (select hi from hist)
        group by all""",
    "stock_daily": f"""
        select article_id, branch_id,
          case when q>0 then 'POSITIVE' when q=0 then 'ZERO' else 'NEGATIVE' end stock_sign_status,
          q>0 is_serviceable,
          case when done is null then 'EXPLICIT_CUTOFF' else 'PROCESS_DATE_MINUS_1' end closed_day_rule,
          count(*) "days", {_r('sum(q)', 'stock_quantity')}, {_checksum('h')} rows_checksum
        from stock group by all""",
    "stock_upsert": f"""
        select article_id, branch_id, count(*) "days", {_r('sum(nq)', 'stock_quantity')},
          {_checksum("""sha256(concat_ws('|', stock_date::varchar, article_id::varchar, branch_id::varchar,
            nq::varchar, coalesce(done::varchar,''), 'true', 'LEGACY'))""")} rows_checksum
        from (select *, cast(q + case when day(stock_date)=10 and article_id%4=0 then 1 else 0 end
            as decimal(18,6)) nq from stock) group by all""",
    "stock_coverage": """
        select stock_date, expected_pairs, known_pairs, positive_pairs,
          known_pairs::double/expected_pairs<0.9 low_coverage,
          coalesce(lag(positive_pairs::double/nullif(known_pairs,0)) over (order by stock_date)
            - positive_pairs::double/nullif(known_pairs,0) > 0.2, false) sharp_drop
        from (
          select c.d stock_date, count(*) expected_pairs, count(s.q) known_pairs,
            count(*) filter (s.q>0) positive_pairs
          from pairs p cross join cal c left join stock s on s.stock_date=c.d
            and s.article_id=p.article_id and s.branch_id=p.branch_id group by 1)""",
    "calendar_panel": """
        select article_id, branch_id, count(*) "days", min(d) first_day, max(d) last_day
        from pairs cross join cal group by all""",
    "raw_daily_rollup": f"""
        select sales_date, article_id, branch_id, n source_row_count, {_r('observed','observed_units')},
          {_r('returned','return_units')}, {_r('amount','sold_amount',2)},
          {_r('eff','effective_unit_price')}, {_r('min_price','min_price')},
          {_r('max_price','max_price')}, f1 special_sale_flag, f2 normal_promo_flag,
          f3 strong_promo_flag, family_id, category_id, cast(null as int) subcategory_id,
          supplier_id sales_supplier_id, sales_date processed_day from raw_daily""",
    "enriched_daily_rollup": f"""
        select sales_date, article_id, branch_id, n enriched_row_count,
          {_r('basal','enriched_basal_units')}, {_r('promo','enriched_promo_units')},
          {_r('score','promo_score_max')}, strong strong_promo_detected from enr_daily""",
    "sales_panel": f"""
        select sales_date, article_id, branch_id, supplier_id, family_id, category_id, source_row_count,
          {_r('observed','observed_units')}, {_r('returned','return_units')},
          {_r('basal','basal_units')}, {_r('promo','promo_units')}, {_r('amount','sold_amount',2)},
          {_r('eff','effective_unit_price')}, true assortment_active,
          availability availability_status, {_r('q','stock_quantity_snapshot')},
          f1 special_sale_flag, f2 normal_promo_flag, f3 or strong strong_promo_flag,
          {_r('score','promo_score_max')}, method promo_adjustment_method, eligible,
          codes exclusion_codes, hash source_hash
        from hpanel where sales_date between date '2001-06-07' and date '2001-08-01'
          or sales_date between date '2000-07-05' and date '2000-08-01'""",
    "panel_history": f"""
        select article_id, branch_id, count(*) "days", count(*) filter (eligible) eligible_days,
          {_r('sum(observed)','observed_units')}, {_r('sum(returned)','return_units')},
          {_r('sum(basal)','basal_units')}, {_r('sum(promo)','promo_units')},
          sum(cast('0x'||substr(md5(hash),1,15) as bigint)::hugeint)::varchar panel_checksum
        from hpanel group by all""",
    "panel_by_bloom": "select * from (@panel_history@)",
    "reconcile_versions": f"""
        with later as (
          select sales_date, article_id, branch_id, availability,
            observed + case when article_id%5=0 and day(sales_date)=3 then 1 else 0 end observed
          from hpanel where not (article_id%7=0 and day(sales_date)=11)
          union all
          select sales_date, article_id, branch_id+100, availability, observed
          from hpanel where article_id%9=0 and day(sales_date)=20)
        select coalesce(o.sales_date, n.sales_date) sales_date,
          coalesce(o.article_id, n.article_id) article_id, coalesce(o.branch_id, n.branch_id) branch_id,
          case when n.article_id is null then 'MISSING_IN_STAGE'
            when o.article_id is null then 'MISSING_IN_SOURCE' else 'DIFFERENT' end difference,
          (o.article_id is not null)::bigint source_rows, (n.article_id is not null)::bigint stage_rows,
          {_r('o.observed','source_units')}, {_r('n.observed','stage_units')}
        from hpanel o full join later n on n.sales_date=o.sales_date and n.article_id=o.article_id
          and n.branch_id=o.branch_id
        where o.article_id is null or n.article_id is null or n.observed<>o.observed
          or n.availability<>o.availability""",
    "availability_matrix": """
        select observed>0 has_sale, case when q is null then 'ABSENT' when q>0 then 'POSITIVE'
            when q=0 then 'ZERO' else 'NEGATIVE' end stock_state,
          availability availability_status, method promo_adjustment_method, eligible, count(*) "days"
        from hpanel group by all""",
    "demand_stats": f"""
        select article_id, branch_id, supplier_id, coalesce(active_days,0) active_days,
          coalesce(eligible_days,0) eligible_days, coalesce(nonzero_days,0) nonzero_days,
          coalesce(reliable,0) promo_reliable_days, coalesce(r_act,0) recent_active_days,
          coalesce(p_act,0) previous_active_days, coalesce(s_act,0) seasonal_active_days,
          coalesce(r_el,0) recent_eligible_days, coalesce(p_el,0) previous_eligible_days,
          coalesce(s_el,0) seasonal_eligible_days, {_r('coalesce(r_u,0)','recent_basal_units')},
          {_r('coalesce(p_u,0)','previous_basal_units')}, {_r('coalesce(s_u,0)','seasonal_basal_units')},
          {_r('r_mean','recent_mean')}, {_r('p_mean','previous_mean')}, {_r('s_mean','seasonal_mean')},
          sha256(coalesce(hashes,'')) features_digest from est""",
    "demand_weights": f"""
        select article_id, branch_id, {_r('avail','available_weight')},
          coalesce(r_el,0)+coalesce(p_el,0)+coalesce(s_el,0) total_window_eligible_days,
          blocked is_blocked, {_r('r_w','recent_weight')}, {_r('p_w','previous_weight')},
          {_r('s_w','seasonal_weight')} from est""",
    "demand_estimate": f"""
        select t business_date, article_id, branch_id, supplier_id, method_code,
          fallback fallback_level, status, round(least(100,greatest(0,100*cover)),2) confidence_score,
          date '2000-07-05' lookback_start, date '2001-08-01' lookback_end, active_days,
          eligible_days, nonzero_days, round(cover,6) availability_coverage,
          round(case when eligible_days>0 then reliable::double/eligible_days else 0 end,6) promo_coverage,
          round(eligible_days::double/nullif(nonzero_days,0),6) adi,
          round(case when nonzero_days>1 then nonzero_days*(nonzero_days*sxx-sx*sx)/((nonzero_days-1)*sx*sx) end,6) cv2,
          {_r('value','raw_demand')}, {_r('value','basal_daily_demand')}, checksum input_checksum,
          date '2001-08-01' cutoff_date, {_r('avail','available_weight')} from est""",
    "demand_status_counts": f"""
        select status, method_code, fallback fallback_level, count(*) pairs,
          {_r('sum(coalesce(value,0))','total_daily_demand')} from est group by all""",
    "network_fallback": f"""
        select e.article_id, e.branch_id,
          case when e.blocked and p.n>=3 then 'WARN' else e.status end status,
          case when e.blocked and p.n>=3 then 'SKU_NETWORK_MEAN' else method_code end method_code,
          cast(case when e.blocked and p.n>=3 then 3 else fallback end as int) fallback_level,
          {_r("case when e.blocked and p.n>=3 then p.total::double/p.n else value end",'basal_daily_demand')}
        from est e left join (select article_id, count(*) n, sum(value) total from est
          where status in ('OK','WARN') group by 1) p using (article_id)""",
    "network_shrinkage": f"""
        with ev as (
          select article_id, branch_id, count(*) n, sum(u)::double s, sum(u*u)::double q from est_j
          where eligible group by all),
        k as (select e.*, ev.n, ev.s, ev.q from est e left join ev using (article_id, branch_id)),
        sums as (
          select article_id, count(*) b, sum(n)::double n, sum(n*n)::double n2, sum(s) s, sum(q) q, sum(s*s/n) r
          from k where status in ('OK','WARN') and n>0 group by 1 having count(*)>=3),
        w as (select *, greatest(coalesce((q-r)/nullif(n-b,0),0),0) wi from sums),
        art as (select article_id, s/n mu, wi, greatest(((r-s*s/n)/(b-1)-wi)/((n-n2/n)/(b-1)),0) bt from w),
        j as (
          select k.*, mu, case when k.n>0 and bt>0 then bt/(bt+wi/k.n) else 0 end own, blocked and mu is not null borrow
          from k left join art using (article_id))
        select article_id, branch_id, case when borrow then 'WARN' else status end status,
          case when borrow then 'SKU_NETWORK_SHRINKAGE' else method_code end method_code,
          cast(case when borrow then 3 else fallback end as int) fallback_level,
          {_r("case when borrow then own*coalesce(s/n,0)+(1-own)*mu else value end",'basal_daily_demand')}
        from j""",
    "freshness_gate": """
        select hi raw_sales_date, (select max(sales_date) from enr) enriched_sales_date,
          (select max(least(last_day(m), case when year(m)=2001 and month(m)=8 then date '2001-08-01'
            else last_day(m) end)) from sdays) stock_source_date,
          (select max(stock_date) from stock) canonical_stock_date,
          least(hi, (select max(sales_date) from enr), (select max(stock_date) from stock)) common_closed_date
        from hist""",
    "source_profile": f"""
        select * exclude (as_of, undated), as_of as_of_ts,
          cast(greatest(date '2001-08-01'-max_business_date,0)*86400 as bigint) freshness_seconds,
          case when undated>0 then 'INVALID' when max_business_date<date '2001-08-01' then 'STALE' else 'VALID' end status,
          source_code<>'events' is_required, 'batch-'||source_code batch_id
        from (
          select 'raw_sales' source_code, min(sales_date) min_business_date, max(sales_date) max_business_date,
            count(*) row_count, 0 undated, {_checksum("article_id||'|'||branch_id||'|'||special_sale")} checksum,
            strftime(max(sales_date), '%Y-%m-%d 00:00:00') as_of from raw
          union all
          select 'enriched_sales', min(sales_date), max(sales_date), count(*), 0,
            {_checksum("article_id||'|'||branch_id")}, null from enr
          union all
          select 'directed_needs', min(vf), max(vf), count(*), 0, {_checksum("line_id||'|'||nt")}, null from dn
          union all
          select 'stock', min(stock_date), max(stock_date), count(*), 0,
            {_checksum("article_id||'|'||branch_id")}, null from stock
          union all
          select 'events', min(ts)::date, max(ts)::date, count(*), 0, {_checksum("k")},
            rtrim(rtrim(strftime(max(ts) + interval 5 minutes, '%Y-%m-%d %H:%M:%S.%f'),'0'),'.') from ev
          union all
          select 'catalog', min(extracted_at)::date, max(extracted_at)::date, count(*),
            count(*) filter (extracted_at is null), {_checksum("article_id||'|'||branch_id")}, null from catalog)
        profiles""",
    "backtest_detail": f"""
        select article_id, branch_id, case when ok then 'VALID' else 'EXCLUDED' end status, {ERRORS},
          {_checksum("""concat_ws('|', origin_date::varchar, evaluation_date::varchar, predicted::varchar,
            actual::varchar, err::varchar, case when ok then 'VALID' else 'EXCLUDED' end, '1', ok::varchar,
            case when ok then '' else 'ACTUAL_NOT_SERVICEABLE' end, checksum)""")} rows_checksum
        from bt group by all""",
    "backtest_metrics": f"""
        with x as (
          select 'ALL' segment_type, 'ALL' segment_id, {SUMS} from bt where ok
          union all select 'ARTICLE', article_id::varchar, {SUMS} from bt where ok group by article_id
          union all select 'BRANCH', branch_id::varchar, {SUMS} from bt where ok group by branch_id)
        select 'model-1' model_version_id, 1 horizon_days, * from ({_metrics('', 'x')})""",
    "backtest_rolling": f"""
        select t business_date, t+1 evaluation_date, article_id, branch_id, {_r('predicted','predicted_demand')},
          {_r('actual','actual_basal_units')}, {_r('err','error_units')}, {_r('abs(err)','absolute_error_units')},
          round(cast(err*err as decimal(24,8))::double,8) squared_error, status
        from (
          select e.t, e.article_id, e.branch_id, e.value predicted,
            cast(coalesce(h.basal,0) as decimal(18,6)) actual,
            cast(coalesce(h.basal,0)-e.value as decimal(18,6)) err,
            case when h.eligible then 'VALID' else 'EXCLUDED' end status
          from aest e left join hpanel h on h.sales_date=e.t+1 and h.article_id=e.article_id
            and h.branch_id=e.branch_id where e.status<>'BLOCKED') x""",
    "model_compare": f"""
        with x as (
          select variant, 'ALL' segment_type, 'ALL' segment_id, {SUMS} from scored group by variant
          union all select variant, 'BRANCH', branch_id::varchar, {SUMS} from scored group by variant, branch_id)
        {_metrics('variant,', 'x')}""",
    "model_acceptance": f"""
        with s2 as (
          select c.variant, c.branch_id, cast(h.basal-c.predicted as decimal(18,6)) err, h.basal actual
          from (select m.t, m.article_id, m.branch_id, 'MEAN_28' variant, m.predicted from mean28 m
              join aest e using (t, article_id, branch_id) where e.value is not null
            union all select m.t, m.article_id, m.branch_id, 'ESTIMATE', e.value from mean28 m
              join aest e using (t, article_id, branch_id) where e.value is not null) c
          join hpanel h on h.sales_date=c.t+1 and h.article_id=c.article_id and h.branch_id=c.branch_id
          where h.eligible),
        x as (
          select variant, 'ALL' segment_type, 'ALL' segment_id, {SUMS} from s2 group by variant
          union all select variant, 'BRANCH', branch_id::varchar, {SUMS} from s2 group by variant, branch_id),
        m as ({_metrics('variant,', 'x')})
        select a.segment_type, a.segment_id, a.metric_code, abs(a.metric_value) candidate,
          abs(b.metric_value) baseline, abs(a.metric_value)<=abs(b.metric_value) accepted
        from m a join m b using (segment_type, segment_id, metric_code)
        where a.variant='ESTIMATE' and b.variant='MEAN_28'""",
    "trailing_mean28": f"""
        select article_id, branch_id, count(m) "days", {_r('sum(m)','sum_of_means')},
          {_r('max(m)','highest_mean')} from (
          select article_id, branch_id, cast((sum(observed) over w)::double/nullif(count(*) over w,0)
            as decimal(18,6)) m from hpanel
          window w as (partition by article_id, branch_id order by sales_date rows between 28 preceding and 1 preceding))
        group by all""",
    "monthly_median_baseline": """
        select m "month", article_id, branch_id, mu median_units, mp median_price, n records from med""",
    "promo_split": f"""
        select article_id, branch_id, cast(score as int) promo_score, count(*) records,
          {_r('sum(units)','units')},
          {_r('sum(case when score>=70 and units>0 then least(units,greatest(mu,0)) else units end)','basal_units')},
          {_r('sum(units-case when score>=70 and units>0 then least(units,greatest(mu,0)) else units end)','promo_units')}
        from psplit group by all""",
    "reconciliation_profile": f"""
        select date_trunc('month',sales_date)::date "month", count(*) row_count, 0::bigint null_rows,
          count(*) filter (abs(units-basal-promo)>0.001) conservation_breaks,
          count(*) filter (score>=70) scored_rows, count(*) filter (strong) strong_rows,
          {_r('sum(units)','units')}, {_r('sum(basal)','basal_units')}, {_r('sum(promo)','promo_units')}
        from enr group by 1""",
    "asof_estimate": f"""
        with q as (
          select t, article_id, branch_id from alldates cross join pairs
          union all select cast(m+n as date), article_id, branch_id from (select max(t) m from alldates),
            (select unnest(range(1,12))::int n), pairs),
        e as (select * from aest where (date_diff('day', date '1970-01-01', t)+article_id)%5<>0)
        select q.article_id, q.branch_id, e.status estimate_status, count(*) positions,
          {_r('sum(e.value)','basal_daily_demand')},
          {_checksum("concat_ws('|', q.t::varchar, e.t::varchar, e.status)")} rows_checksum
        from q asof left join e on e.article_id=q.article_id and e.branch_id=q.branch_id and q.t>=e.t
        group by all""",
    "interval_params": f"""
        select p.article_id, p.branch_id,
          case when x.lt is not null then 'PAIR' when w.lt is not null then 'ARTICLE' end parameter_level,
          min(d.t) first_date, max(d.t) last_date, count(*) positions,
          {_r('sum(coalesce(x.lt,w.lt))','lead_time_days')},
          {_r('sum(coalesce(x.ts,w.ts))','target_stock_days')}, {_r('sum(coalesce(x.os,w.os))','overstock_days')}
        from pairs p cross join alldates d
        left join params x on x.article_id=p.article_id and x.branch_id=p.branch_id
          and d.t between x.vf and coalesce(x.vt, date '9999-12-31')
        left join params w on w.article_id=p.article_id and w.branch_id is null
          and d.t between w.vf and coalesce(w.vt, date '9999-12-31')
        group by all""",
    "net_stock": f"""
        select date '2001-08-02' business_date, article_id, branch_id, supplier_id,
          {_r('physical','physical_stock')}, {_r('inbound','direct_po_inbound')},
          {_r('transit','cd_in_transit')}, {_r('committed','special_sale_committed')},
          {_r('net','net_stock')}, status calculation_status, alerts alert_codes from pos3""",
    "thresholds": f"""
        select article_id, branch_id, {_r('demand','basal_daily_demand')}, {_r('crit','critical_stock')},
          {_r('mn','minimum_stock')}, {_r('mx','maximum_stock')}, {_r('ov','overstock_quantity')},
          {_r('cover','coverage_days')} from pos3""",
    "needs_ds": f"""
        select article_id, branch_id, nt need_type, mand is_mandatory, {_r('q','calculated_quantity')},
          {_r('upp','rounding_unit')}, {_r('rounded','rounded_quantity')},
          case when pstat='BLOCKED' then 'BLOCKED' when q=0 then 'ZERO' else 'CALCULATED' end calculation_status,
          risk risk_score from needs""",
    "run_summary": f"""
        select nt need_type, mand is_mandatory,
          case when pstat='BLOCKED' then 'BLOCKED' when q=0 then 'ZERO' else 'CALCULATED' end calculation_status,
          count(*) "rows", {_r('sum(q)','quantity')},
          count(*) filter (pstat in ('BLOCKED','ZERO_PDVB')) warnings from needs group by all""",
    "run_controls": """
        select * from (
          select 'estimate' entity_type, 'ERROR' severity, 'PAIR_WITHOUT_ESTIMATE' issue_code, count(*) issues
          from later_pairs where (article_id, branch_id) not in (select (article_id, branch_id) from est)
          union all
          select 'estimate', 'WARN', 'DEMAND_JUMP', count(*) from est e join pest p
            on p.article_id=e.article_id and p.branch_id=e.branch_id and p.status<>'BLOCKED'
          where e.value>p.value*3 or e.value*3<p.value) where issues>0""",
    "import_versions": """
        select line_id, case when user_id%17=0 then 'NOT_FOUND' when user_id%11=0 then 'STALE_VERSION'
          else 'CURRENT' end version_status, count(*) requests from req group by all""",
    "stockout_risk": f"""
        select risk risk_score, count(*) pairs, {_r('sum(q)','needed')} from needs where nt='D' group by 1""",
    "automatic_balance": f"""
        select article_id, branch_id, nt need_type, {_r('rounded','rounded_quantity')},
          {_r('open','open_quantity')} from opened""",
    "rounding_logistics": f"""
        select article_id, branch_id, nt need_type, {_r('rounded','rounded_quantity')},
          {_r('rounded/l.upp','estimated_packages',4)}, {_r('rounded/l.upp/l.ppp','estimated_pallets',4)},
          {_r('rounded*l.kg','estimated_weight_kg',4)}, {_r('rounded*l.m3','estimated_volume_m3',4)},
          l.quality logistics_status, l.quality<>'COMPLETE' logistics_data_missing
        from needs join logi2 l using (article_id)""",
    "directed_balance": f"""
        select line_id, nt need_type, nt<>'A' is_mandatory, {_r('qty','original_quantity')},
          {_r('open','open_quantity')},
          case when open=0 and canc>0 then 'CANCELLED' when open=0 then 'FULFILLED'
            when open<qty then 'PARTIAL' else 'OPEN' end line_status,
          coalesce(vt<date '2001-08-02',false) and open>0 is_expired from dn""",
    "need_validation": f"""
        select reject_codes, count(*) lines, {_r('sum(qty)','quantity')} from (
          select qty, concat_ws(',',
            case when count(*) over (partition by ref, article_id, branch_id)>1 then 'SOURCE_DUPLICATE' end,
            case when article_id=9 then 'UNKNOWN_ARTICLE' end,
            case when branch_id=3 then 'UNKNOWN_BRANCH' end) reject_codes from dn)
        group by 1""",
    "need_masters": """
        select reject_codes, count(*) lines from (
          select concat_ws(',', case when branch_id%6=0 then 'INVALID_UNIT' end,
            case when article_id%4=0 then 'UNKNOWN_SUPPLIER' end) reject_codes from dn) group by 1""",
    "reference_alerts": """
        select line_id, 'DUPLICATE_REFERENCE' alert_code from (@duplicate_needs@)
        where overlaps_earlier or overlaps_later""",
    "duplicate_needs": """
        select line_id, nt need_type, ref reference, article_id, branch_id, vf valid_from, vt valid_to,
          hi>=vf is true overlaps_earlier, nx<=coalesce(vt, date '9999-12-31') is true overlaps_later
        from (
          select *, max(coalesce(vt, date '9999-12-31')) over (w rows between unbounded preceding and 1 preceding) hi,
            lead(vf) over w nx
          from dn window w as (partition by nt, ref, branch_id, article_id order by vf, line_id))
        where hi>=vf or nx<=coalesce(vt, date '9999-12-31')""",
    "backlog_consolidated": f"""
        select line_id, origin_id, article_id, branch_id, sk supplier_key, {_r('dq','d_open_quantity')},
          {_r('eq','e_open_quantity')}, {_r('cq','c_open_quantity')}, {_r('aq','a_open_quantity')},
          {_r('sq','s_open_quantity')}, {_r('mand','mandatory_open_quantity')},
          {_r('opt','optional_open_quantity')}, {_r('total','total_open_quantity')}, risk risk_score,
          oldest oldest_need_date, target target_date, commit_date commitment_date, n source_count,
          {_r('imported','imported_quantity')}, {_r('prepared','prepared_quantity')},
          {_r('transit','in_transit_quantity')}, quality logistics_status from ln""",
    "backlog_priority": """
        select line_id, cast(pclass as int) priority_class, risk risk_score, rnk priority_rank from rk""",
    "top_priorities": f"""
        select line_id, rnk priority_rank, {_r('total','total_open_quantity')} from rk where rnk<=5""",
    "backlog_page": """
        select pos "position", line_id, rnk priority_rank from found where pos between 26 and 50""",
    "backlog_snapshot_page": """
        select 'v1' snapshot_version, pos "position", line_id, rnk priority_rank from found where pos<=50""",
    "backlog_snapshot_totals": f"""
        select 'v1' snapshot_version, count(*) lines, {_r('sum(total)','units',3)},
          {_r('sum(mand)','mandatory_units',3)} from found
        union all
        select 'v2', count(*), {_r('sum(total)','units',3)}, {_r('sum(mand)','mandatory_units',3)}
        from found where article_id%7<>0""",
    "backlog_search_totals": f"""
        select count(*) lines, {_r('sum(total)','units',3)}, {_r('sum(mand)','mandatory_units',3)},
          {_r('sum(opt)','optional_units',3)}, {_r('sum(total*kg)','kg',2)},
          {_r('sum(total/upp)','packages',2)}, {_r('sum(total/upp/ppp)','pallets',2)} from found""",
    "attribution": f"""
        select article_id, branch_id, nt need_type, source_id, step attribution_step,
          {_r('open','open_quantity')},
          {_r('greatest(0, least(open, coalesce(prepared,0)*20 - coalesce(run,0)))','allocated_quantity')}
        from (
          select *, sum(open) over (partition by article_id, branch_id
            order by step, coalesce(target, date '9999-12-31'), nd, source_id
            rows between unbounded preceding and 1 preceding) run
          from (select *, cast(case when nt='E' and target<date '2001-08-02' then 1 when nt='E' then 2
              when nt='C' then 3 when nt='D' then 4 when nt='A' then 5 else 6 end as int) step from src)) s
        left join lexec using (article_id, branch_id)""",
    "cd_coverage": f"""
        select date '2001-08-02' business_date, c.article_id, {_r('phys','physical_stock')},
          {_r('coalesce(ontime,0)','open_po_on_time')}, {_r('coalesce(overdue,0)','open_po_overdue')},
          {_r('coalesce(mand,0)','mandatory_backlog')}, {_r('coalesce(opt,0)','optional_backlog')},
          round((phys+coalesce(ontime,0))::double/nullif(coalesce(mand,0)+coalesce(opt,0),0)::double,6) coverage_index,
          case when coalesce(overdue,0)>0 then 'WARN' else 'OK' end status
        from (select cast(substr(p_brand,7) as int) article_id, count(*)*10 phys from part group by 1) c
        left join (select cast(substr(p_brand,7) as int) article_id,
            sum(l_quantity) filter (l_shipdate::date>=date '2001-08-02') ontime,
            sum(l_quantity) filter (l_shipdate::date<date '2001-08-02') overdue
          from lineitem join part on p_partkey=l_partkey where l_linestatus='O' group by 1) o using (article_id)
        left join (select article_id, sum(mand) mand, sum(opt) opt from ln group by 1) b using (article_id)""",
    "backlog_alerts": """
        select line_id, unnest(list_filter([
            case when risk>=100 then 'STOCKOUT' end,
            case when risk>=90 and risk<100 then 'CRITICAL_COVERAGE' end,
            case when pclass=1 then 'COMMITMENT_OVERDUE' end,
            case when pclass=2 then 'COMMITMENT_DUE' end,
            case when fresh<>'CURRENT' then 'STALE_DATA' end,
            case when imported>0 and prepared=0 and branch_id%5>=2 then 'IMPORT_WITHOUT_PROGRESS' end,
            case when prepared>0 and prepared<imported then 'PARTIAL_PREPARATION' end,
            case when article_id%11=0 then 'UNKNOWN_EXTERNAL_STATUS' end,
            case when prepared>imported then 'INVALID_DIFFERENCE' end], lambda x: x is not null)) alert_code,
          fresh freshness_status
        from (select *, case when article_id%8=7 then 'INCOMPLETE' when branch_id%9=0 then 'STALE'
          else 'CURRENT' end fresh from ln)""",
    "panel_kpis": """
        select origin_id, count(*) lines, count(*) filter (risk>=100) lines_at_risk,
          count(*) filter (pclass=1) overdue_commitments, count(*) filter (pclass=2) due_commitments,
          count(*) filter (prepared>0 and prepared<imported) partial_lines,
          count(*) filter (imported>0 and prepared=0) lines_without_progress,
          count(*) filter (quality<>'COMPLETE') missing_logistics from ln group by 1""",
    "run_difference": """
        with g as (select *, case when branch_id%4=0 then net-2 else net end net2 from pos2 where article_id<>7),
        g2 as (select *, case when status='ZERO_PDVB' then 0 when status<>'BLOCKED' then greatest(mx-net2,0) end dq2,
            cast(case when status in ('BLOCKED','ZERO_PDVB') then null when net2<=0 then 100
              when cover<lt then 90 when cover<=2*lt then 50 when cover<ts then 25 else 0 end as int) risk2 from g),
        after as (
          select article_id, branch_id, 'D' nt, dq2 q, risk2 from g2
          union all
          select article_id, branch_id, 'S', case when status='ZERO_PDVB' then 0
            when status<>'BLOCKED' then greatest(mx+ov-greatest(net2,0)-dq2,0) end, risk2 from g2)
        select * from (
          select coalesce(n.article_id,a.article_id) article_id, coalesce(n.branch_id,a.branch_id) branch_id,
            coalesce(n.nt,a.nt) need_type,
            case when n.nt is null then 'ADDED' when a.nt is null then 'REMOVED' else 'CHANGED' end change,
            concat_ws(',', case when n.q is distinct from a.q then 'calculated_quantity' end,
              case when n.risk is distinct from a.risk2 then 'risk_score' end) changed_columns
          from needs n full join after a on a.article_id=n.article_id and a.branch_id=n.branch_id and a.nt=n.nt)
        where change<>'CHANGED' or changed_columns<>''""",
    "import_outcomes": f"""
        select k idempotency_key, line_id, ver line_version, {_r('q','quantity')},
          case when ts0<timestamp '2024-01-04' then 'ALREADY_ACCEPTED' when not q>0 then 'INVALID'
            when user_id%17=0 then 'NOT_FOUND' when ver<>1+user_id%3 then 'STALE_VERSION'
            when q>50+user_id%100 then 'QUANTITY_EXCEEDS_OPEN' else 'ACCEPTED' end outcome,
          n-1 replays
        from (select k, line_id, user_id, arg_min(ver, ts) ver, arg_min(q, ts) q, min(ts) ts0, count(*) n
          from req group by all)""",
    "import_header_totals": f"""
        select 'IMP-'||(user_id%50) import_id, count(*) line_count,
          {_r('sum(imported)','total_imported_quantity',3)},
          {_r('sum(prepared)','total_prepared_quantity',3)} from fold group by 1""",
    "events_dedup_fold": f"select {STATE} from fold",
    "stream_fold": f"select {STATE} from fold",
    "stream_log": f"select k dedup_key, line_id, et event_type, {_r('q','quantity')} from ev",
    "stream_corrections": f"""
        select k dedup_key, line_id, et event_type, {_r('q','quantity')},
          'CUMULATIVE_DECREASED' correction_alert from evd where qm='CUMULATIVE' and q<hi""",
    "cumulative_to_delta": f"""
        select k dedup_key, line_id, et event_type, qm quantity_mode, {_r('q','quantity')},
          {_r("case when qm='DELTA' then q else greatest(q-coalesce(hi,0),0) end",'delta_quantity')},
          case when qm='CUMULATIVE' and q<coalesce(hi,0) then 'CORRECTED' else et end record_type,
          case when qm='CUMULATIVE' and q<coalesce(hi,0) then 'CUMULATIVE_DECREASED' else '' end correction_alert
        from evd""",
    "status_normalized": """
        select k dedup_key, ext external_status, norm normalized_status,
          case when norm='UNKNOWN' then 'UNKNOWN_EXTERNAL_STATUS' else '' end alert_codes from ev""",
    "events_quarantine": """
        select * from (
          select k dedup_key, ev.line_id, concat_ws(',',
            case when f.prepared>f.imported and et='PREPARED' then 'PREPARED_EXCEEDS_IMPORTED' end,
            case when ev.user_id%17=0 then 'UNKNOWN_REFERENCE' end) isolation_codes
          from ev join fold f on f.line_id=ev.line_id) where isolation_codes<>''""",
    "events_orphans": "select k dedup_key, line_id from ev where user_id%17=0",
    "execution_remaining": f"""
        select line_id, {_r('greatest(2000-greatest(prepared,dispatched)-cancelled,0)','open_quantity',3)},
          {_r('greatest(imported-prepared,0)','import_unprepared',3)} from fold""",
    "idle_imports": f"""
        select line_id, cast(date '2024-01-31'-last_ts::date as int) idle_days,
          {_r('imported','imported_quantity',3)} from fold
        where imported>prepared and last_ts::date<date '2024-01-31'-1""",
    "events_daily_counts": f"""
        select ts::date "day", et event_type, count(*) events, {_r('sum(q)','quantity',3)},
          300::bigint max_lag_seconds from ev group by 1, 2""",
    "publish_current": f"""
        select t business_date, article_id, branch_id, status, {_r('value','basal_daily_demand')} from (
          select t, article_id, branch_id, status, value from est where status<>'BLOCKED'
          union all
          select p.t, p.article_id, p.branch_id, p.status, p.value from pest p
          where p.status<>'BLOCKED' and (p.article_id, p.branch_id) in (select (article_id, branch_id) from later_pairs)
            and (p.article_id, p.branch_id) not in (select (article_id, branch_id) from est where status<>'BLOCKED'))""",
    "publish_replay": f"""
        select t business_date, article_id, branch_id, status, {_r('value','basal_daily_demand')} from (
          select t, article_id, branch_id, status, value from est where status<>'BLOCKED'
          union all
          select p.t, p.article_id, p.branch_id, p.status, p.value from pest p
          where p.status<>'BLOCKED'
            and (p.article_id, p.branch_id) not in (select (article_id, branch_id) from est where status<>'BLOCKED'))""",
    "version_history": """
        select o_custkey customer, o_orderkey "version", o_orderdate::date changed_on,
          '{"status":"'||o_orderstatus||'","priority":"'||o_orderpriority||'"}' after_state,
          lag('{"status":"'||o_orderstatus||'","priority":"'||o_orderpriority||'"}') over w before_state,
          lead(o_orderdate::date) over w superseded_on
        from orders window w as (partition by o_custkey order by o_orderkey)""",
    "stream_daily": f"""
        select ts::date "day", et event_type, count(*) events, {_r('sum(q)','quantity',3)} from ev group by 1, 2""",
    "stream_idle": f"""
        select line_id, cast(date '2024-01-31'-last_ts::date as int) idle_days,
          {_r('imported','imported_quantity',3)} from fold
        where imported>prepared and last_ts::date<date '2024-01-31'-1""",
    "publish_staged": f"""
        select t business_date, article_id, branch_id, status, {_r('value','basal_daily_demand')} from (
          select t, article_id, branch_id, status, value from est where status<>'BLOCKED'
          union all
          select p.t, p.article_id, p.branch_id, p.status, p.value from pest p
          where p.status<>'BLOCKED'
            and (p.article_id, p.branch_id) not in (select (article_id, branch_id) from est where status<>'BLOCKED'))""",
    "retire_pairs": """
        select article_id, branch_id, status from pest p where status<>'BLOCKED'
          and (article_id, branch_id) not in (select (article_id, branch_id) from later_pairs)""",
    "quality_violations": """
        select 'stock' entity_type, 'INFO' severity, 'STOCK_NEGATIVE' issue_code, count(*) issues
        from stock where q<0
        union all select 'sales', 'INFO', 'STOCK_UNKNOWN', count(*) from hpanel where availability='UNKNOWN'
        union all select 'sales', 'ERROR', 'UNITS_CONSERVATION', count(*) from hpanel
          where abs(greatest(observed,0)-basal-promo)>0.001 having count(*)>0
        union all select 'estimate', 'WARN', 'INSUFFICIENT_DATA', count(*) from est where blocked having count(*)>0
        union all select 'need', 'WARN', 'NEED_BLOCKED', count(*) from needs where pstat='BLOCKED' having count(*)>0""",
    "quality_broken": """
        select * from (
          select 'stock' entity_type, 'ERROR' severity, 'STOCK_SIGN' issue_code, count(*) issues from stock where article_id%5=0
          union all select 'stock', 'ERROR', 'STOCK_DATE_PARTS', count(*) from stock where branch_id%7=0
          union all select 'stock', 'INFO', 'STOCK_NEGATIVE', count(*) from stock where q<0
          union all select 'sales', 'ERROR', 'UNITS_CONSERVATION', count(*) from hpanel where article_id%4=0
          union all select 'sales', 'ERROR', 'ELIGIBLE_AVAILABLE', count(*) from hpanel
            where article_id%4=1 and availability in ('UNKNOWN','OUT_OF_STOCK')
          union all select 'sales', 'ERROR', 'STOCK_LINEAGE', count(*) from hpanel
            where article_id%4=2 and availability in ('IN_STOCK','OUT_OF_STOCK')
          union all select 'sales', 'ERROR', 'UNKNOWN_WITHOUT_STOCK', count(*) from hpanel
            where article_id%4=3 and availability='UNKNOWN'
          union all select 'sales', 'INFO', 'STOCK_UNKNOWN', count(*) from hpanel where availability='UNKNOWN'
          union all select 'estimate', 'BLOCKER', 'LOOKBACK', count(*) from est where article_id%6=0
          union all select 'estimate', 'ERROR', 'DAY_COUNTS', count(*) from est where article_id%6=1
          union all select 'estimate', 'BLOCKER', 'BLOCKED_WITHOUT_VALUE', count(*) from est where article_id%6=2 and not blocked
          union all select 'estimate', 'BLOCKER', 'VALUE_NOT_NEGATIVE', count(*) from est where article_id%6=3 and not blocked
          union all select 'estimate', 'ERROR', 'ZERO_VALID', count(*) from est where article_id%6=3 and status='ZERO_VALID'
          union all select 'estimate', 'ERROR', 'WEIGHTS_SUM', count(*) from est where article_id%6=4 and not blocked
          union all select 'estimate', 'ERROR', 'COVERAGE_RANGE', count(*) from est where article_id%6=5
          union all select 'estimate', 'WARN', 'INSUFFICIENT_DATA', count(*) from est where blocked
          union all select 'estimate', 'ERROR', 'PUBLICATION_PAIR', count(*) from est where article_id%2=0
          union all select 'need', 'ERROR', 'NEED_CLASS', count(*) from needs where article_id%3=0
          union all select 'need', 'ERROR', 'NEED_QUANTITIES', count(*) from needs where article_id%3=1 and pstat<>'BLOCKED'
          union all select 'need', 'ERROR', 'NEED_ZERO', count(*) from needs where article_id%3<>0 and pstat<>'BLOCKED' and q=0
          union all select 'need', 'WARN', 'NEED_BLOCKED', count(*) from needs where pstat='BLOCKED'
          union all select 'directed', 'ERROR', 'LINE_BALANCE', count(*) from dn where article_id%2=0
          union all select 'directed', 'ERROR', 'LINE_STATUS', count(*) from dn where article_id%2=1 and (open=0 or open=qty)
          union all select 'backtest', 'ERROR', 'EVALUATION_DATE', count(*) from bt where article_id%4 in (0,1)
          union all select 'backtest', 'ERROR', 'HORIZON', count(*) from bt where article_id%4=1
          union all select 'backtest', 'ERROR', 'NOT_NEGATIVE', count(*) from bt where article_id%4=2
          union all select 'backtest', 'ERROR', 'STATUS', count(*) from bt where article_id%4=3
          union all select 'position', 'ERROR', 'POSITION_FORMULAS', count(*) from pos where article_id%2=0 and mx is not null
          union all select 'position', 'ERROR', 'ESTIMATE_DATE', count(*) from pos where article_id%2=1
          union all select 'position', 'WARN', 'POSITION_BLOCKED', count(*) from pos where status='BLOCKED'
          union all select 'import', 'ERROR', 'IMPORT_PREPARED', count(*) from lexec where article_id%2=0 or prepared>imported
        ) where issues>0""",
    "declared_duplicates": """
        select * from (
          select 'stock_daily' entity_type, 'BLOCKER' severity, 'DUPLICATE_KEY' issue_code, count(*) issues from stock where article_id%5=0
          union all select 'sales_daily', 'BLOCKER', 'DUPLICATE_KEY', count(*) from hpanel where article_id%5=0
          union all select 'demand_estimate', 'BLOCKER', 'DUPLICATE_KEY', count(*) from est where article_id%5=0
          union all select 'backtest_detail', 'BLOCKER', 'DUPLICATE_KEY', count(*) from bt where article_id%5=0
        ) where issues>0""",
    "input_controls": """
        select * from (
          select 'source' entity_type, 'BLOCKER' severity, 'SOURCE_BEHIND_CUTOFF' issue_code, count(*) issues from (
            select branch_id from raw group by 1 having max(sales_date) < (select hi-5 from hist))
          union all
          select 'source', 'ERROR', 'FUTURE_OBSERVATION', count(distinct sales_date) from raw
          where sales_date > (select hi-5 from hist)) where issues>0""",
    "output_controls": """
        select 'branch' entity_type, 'WARN' severity, 'ASSORTMENT_COVERAGE' issue_code, p.branch_id
        from later_pairs p left join (select article_id, branch_id from est where not blocked) e
          on e.article_id=p.article_id and e.branch_id=p.branch_id
        group by p.branch_id having count(e.article_id)::double/count(*)<0.95""",
    "resolved_issues": """
        select 'STOCK_NEGATIVE' issue_code, case when article_id%3=0 then 'planner' end resolved_by,
          count(*) issues from stock where q<0 group by 2""",
    "reader_round_trip": """
        select 'catalog' relation, count(*) "rows", sum(article_id::bigint*branch_id)::bigint key_sum from catalog
        union all select 'raw_sales', count(*), sum(article_id::bigint*branch_id)::bigint from raw
        union all select 'enriched_sales', count(*), sum(article_id::bigint*branch_id)::bigint from enr
        union all select 'wide_stock', count(*), sum(article_id::bigint*branch_id)::bigint from (
          select distinct article_id, branch_id, year(stock_date) y, month(stock_date) m from stock_all)""",
    "sales_upsert": f"""
        select p.article_id, p.branch_id, (select (hi-lo+1)::bigint from hist) "days",
          {_r('coalesce(max(x.u),0)','observed_units')}
        from pairs p left join (
          select article_id, branch_id, sum(greatest(units+case when article_id%4=0 then 1 else 0 end,0)) u
          from raw group by 1, 2) x
          on x.article_id=p.article_id and x.branch_id=p.branch_id
        group by all""",
    "store_retention": """
        select strftime(stock_date,'%Y-%m') "month", count(*) "rows" from stock
        where stock_date>=date '2000-09-01' group by 1""",
    "scope_manifest_file": """
        select article_count, pair_count, destination_count, scope_checksum from (@scope_manifest@)""",
    "duplicate_keys": """
        select 'BLOCKER' severity, 'DUPLICATE_KEY' issue_code,
          '{"l_orderkey":'||l_orderkey||',"l_linenumber":'||l_linenumber||'}' entity_key
        from lineitem group by l_orderkey, l_linenumber having count(*)>1""",
    "scoped_blocking": """
        select article_id, branch_id, case when (article_id, branch_id) in (
            select (article_id, branch_id) from stock
            where stock_date between date '2001-07-05' and date '2001-08-01')
          then 'READY' else 'BLOCKED' end state from pairs""",
    "audit_diff": """
        select coalesce(o.article_id,n.article_id)||'|'||coalesce(o.branch_id,n.branch_id) entity_id,
          case when o.article_id is null then 'CREATED' when n.article_id is null then 'REMOVED'
            else 'CHANGED' end event_type,
          case when o.article_id is not null then '{"supplier_id":'||o.supplier_id||'}' end before_state,
          case when n.article_id is not null then '{"supplier_id":'||n.supplier_id||'}' end after_state
        from pairs o full join later_pairs n on n.article_id=o.article_id and n.branch_id=o.branch_id
        where o.article_id is null or n.article_id is null or o.supplier_id is distinct from n.supplier_id""",
    "explain_needs": f"""
        select n.article_id, n.branch_id, nt need_type,
          case nt when 'D' then 'max(demand * target_days - net_stock, 0)'
            else 'max(maximum + overstock - max(net_stock, 0) - D, 0)' end formula,
          {_r('p.net','net_stock')}, 'batch-1' batch_id, {_r('p.ts','target_stock_days')},
          date '2001-08-02' estimate_date, {_r('p.mx','maximum_stock')}
        from needs n join pos3 p on p.article_id=n.article_id and p.branch_id=n.branch_id""",
    "backfill_run": f"""
        select t business_date, article_id, branch_id, status, {_r('value','basal_daily_demand')},
          checksum input_checksum from est""",
}


QUERIES |= {
    "scope_manifest_ordered": """
        with ac as (
          select sha256(string_agg(concat_ws('|', article_id, article_id*10, 1, 1, 1, 1), chr(10) order by article_id)) ac
          from origin),
        pc as (
          select sha256(string_agg(concat_ws('|', branch_id, article_id, coalesce(supplier_id::varchar,''), '41CD', 0, 1, 1, 1),
            chr(10) order by branch_id, article_id)) pc from pairs)
        select (select count(*) from origin) article_count, count(*) pair_count,
          count(distinct branch_id) destination_count, count(distinct article_id) routed_article_count,
          '2001-08-01 03:00:00' source_as_of_ts, ac article_checksum, pc pair_checksum,
          sha256('articles:'||ac||'|pairs:'||pc) scope_checksum
        from pairs, ac, pc group by ac, pc""",
    "scope_gates": """
        with both_sides as (
          select coalesce(o.branch_id, n.branch_id) branch_id, count(o.article_id) b, count(n.article_id) a,
            count(*) filter (o.article_id is null or n.article_id is null) m
          from pairs o full join later_pairs n on n.article_id=o.article_id and n.branch_id=o.branch_id
          group by 1),
        whole as (select sum(b) b, sum(a) a, sum(m) m from both_sides)
        select 'scope' entity_type, 'ERROR' severity, 'INVALID_ROUTE' issue_code, branch_id,
          count(*)+count(*) filter (article_id%5=0) issues from later_pairs where branch_id%6=0 group by branch_id
        union all select 'scope', 'BLOCKER', 'DUPLICATE_KEY', branch_id, count(*)
          from later_pairs where article_id%5=0 group by branch_id
        union all select 'scope', 'BLOCKER', 'SCOPE_EMPTY', null, 1 from whole where a=0
        union all select 'scope', 'ERROR', 'SCOPE_VARIATION', null, 1 from whole where b>0 and m>b*0.1::double
        union all select 'branch', 'WARN', 'NEW_BRANCH', branch_id, 1 from both_sides where b=0
        union all select 'branch', 'WARN', 'BRANCH_VARIATION', branch_id, 1
          from both_sides where b>0 and m>b*0.1::double""",
    "value_controls": """
        select 'estimate' entity_type, 'BLOCKER' severity, 'VALUE_NOT_FINITE' issue_code, count(*) issues
        from est where article_id%6 in (1,2,3) having count(*)>0""",
    "allocation_controls": """
        select 'ERROR' severity, 'ALLOCATION' issue_code, article_id, count(*) issues
        from src where article_id%4 in (0,1) group by article_id""",
    "daily_run": "select * from (@backfill_run@)",
    "backtest_stored": "select * from (@backtest_detail@)",
    "day_close": f"""
        select line_id, cast(pclass as int) priority_class, risk risk_score, rnk priority_rank,
          {_r('total','total_open_quantity')}, {_r('imported','imported_quantity')},
          {_r('prepared','prepared_quantity')} from rk_day""",
    "runs_in_force": """
        select o_orderpriority run_type, date_trunc('month', o_orderdate)::date business_date,
          'scope-'||(o_custkey%3) scope_id, max(o_orderkey)::varchar run_id, max(o_orderkey)::int attempt_no
        from orders where o_orderstatus='F' group by 1, 2, 3""",
    "publish_log": """
        with n as (select count(*) n, count(*) filter ((article_id, branch_id) not in
          (select (article_id, branch_id) from later_pairs)) strange from est)
        select 'batch-1' batch_id, 'PENDING' status, 0 "rows"
        union all select 'batch-1', unnest(['STAGING','VALIDATED','PUBLISHED']), n from n
        union all select 'batch-2', 'PENDING', 0
        union all select 'batch-2', unnest(['STAGING','FAILED']), n from n
        union all select 'batch-2', 'OUTSIDE', strange from n
        union all select 'run', 'SUCCEEDED', 1
        union all select 'run', 'FAILED', 2""",
    "import_files": "select * from (@import_outcomes@)",
    "positions_from_files": "select * from (@net_stock@)",
    "job_results": """
        select load, 'stock_daily' job, lo first_day, hi last_day,
          case load when 1 then n else 0 end inserted, case load when 2 then c else 0 end updated,
          case load when 1 then m when 2 then mc else 0 end "months",
          stored_first, stored_last, n stored_rows
        from (select cast(unnest([1,2,3]) as int) load), hist, (
          select count(*) n, count(*) filter (article_id%4=0) c,
            count(distinct date_trunc('month', stock_date))::int m,
            (count(distinct date_trunc('month', stock_date)) filter (article_id%4=0))::int mc,
            min(stock_date) stored_first, max(stock_date) stored_last from stock)""",
}
# Codes are joined in alphabetical order.
QUERIES["directed_upload"] = """
    select concat_ws(',', case when k%7 in (0,1) then 'INVALID_QUANTITY' end,
        case when k%5=0 then 'INVALID_TYPE' end, case when k%3=0 then 'INVALID_VALIDITY' end,
        case when k%13=0 then 'MISSING_ARTICLE' end, case when k%11=0 then 'MISSING_BRANCH' end,
        case when k%7=0 then 'UNREADABLE_LINE' end) reject_codes,
      count(*) lines, """ + _r("sum(case when k%7=0 then null when k%7=1 then -1 else qty end)", "quantity") + """
    from dn group by 1"""
# The later scope has other pairs but the same articles.
QUERIES["scope_versions"] = """
    select 'first' step, 1 version_no, true is_new, scope_checksum from (@scope_manifest@)
    union all select 'again', 1, false, scope_checksum from (@scope_manifest@)
    union all select 'later', 2, true, scope_checksum from (""" + re.sub(
        r"\bfrom pairs\b", "from later_pairs", QUERIES["scope_manifest"]
    ) + ")"


def _needed(text: str) -> list[str]:
    """The common table expressions a statement uses, in order of definition."""
    words = set(re.findall(r"\w+", text))
    wanted: set[str] = set()
    for name in reversed(list(BASE)):
        if name in words:
            wanted.add(name)
            words |= set(re.findall(r"\w+", BASE[name]))
    return [n for n in BASE if n in wanted]


def statement(name: str) -> str:
    # A statement may contain another one by its name.
    body = re.sub(r"@(\w+)@", lambda found: QUERIES[found[1]], QUERIES[name])
    kept = {n: " materialized" for n in ("hpanel", "trail", "daily")}
    ctes = ",\n".join(f"{n} as{kept.get(n, '')} ({BASE[n]})" for n in _needed(body))
    return f"{'with ' + ctes if ctes else ''}\nselect * from ({body}) result"


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
