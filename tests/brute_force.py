"""Region preparation in plain Python, one region and one step at a time."""

from __future__ import annotations

import re

from salesprep import contracts

NAMES = contracts.SALES.names
MONTH = re.compile(r"\d{4}/(0[1-9]|1[0-2])$")


def first(value):
    """Sort key: null first."""
    return (value is not None, value if value is not None else "")


def outlet_of(store):
    return store.split("_", 1)[1] if store is not None and "_" in store else ""


def number(text):
    try:
        return float(text.replace(",", ""))
    except (AttributeError, ValueError):
        return None


def last_months(rows, count):
    return set(sorted({r["year_month"] for r in rows if r["year_month"] and MONTH.match(r["year_month"])})[-count:])


def usable_pos(pos):
    return [p for p in pos if p["sales_rep_code"] and p["partner_code"] is not None and p["pos_code"] is not None and p["pos_status"] == "1"]


def one_region(rows, pos, restricted, route, profile, unmatched):
    rows = [dict(r) for r in rows]
    for r in rows:
        for name in ("bucket", "outlet_category_name"):
            r[name] = r[name] and r[name].strip(" \t\r\n")
    rows = [r for r in rows if (r["value_sales"] or 0) > 0 and (r["vol_sales"] or 0) > 0]
    rows = [r for r in rows if r["bucket"] is None or "Based on" not in r["bucket"]]

    keys = ("year_month", "city", "store_code", "brand", "product_sku_code", "value_sales", "vol_sales")
    order = ["address"] + [n for n in NAMES if n not in keys and n not in ("region", "address")]
    seen, unique = set(), []
    for r in sorted(rows, key=lambda r: [first(r[n]) for n in order]):
        key = tuple(r[k] for k in keys)
        if key not in seen:
            seen.add(key)
            unique.append(r)
    rows = unique

    newest = {}
    for r in rows:
        rank = (r["year_month"] is None, first(r["year_month"]), first(r["outlet_category_name"]), first(r["bucket"]))
        if r["store_code"] not in newest or rank > newest[r["store_code"]][0]:
            newest[r["store_code"]] = (rank, r["outlet_category_name"], r["bucket"])
    rows = [dict(r, outlet_category_name=newest[r["store_code"]][1], bucket=newest[r["store_code"]][2]) for r in rows]

    partners = {}
    for p in usable_pos(pos):
        partners.setdefault(p["pos_code"], set()).add(p["partner_code"])
    moved = []
    for r in rows:
        outlet = outlet_of(r["store_code"])
        found = partners.get(outlet.replace(">", "_"))
        if found:
            moved += [dict(r, store_code=f"{partner}_{outlet}") for partner in found]
        elif unmatched == "keep":
            moved.append(r)
        else:
            moved.append(dict(r, store_code=f"NA_{outlet}"))
    rows = moved

    focus = last_months(rows, profile.focus_months) if profile.focus_months else set()
    if profile.route_stores:
        rows = [r for r in rows if r["store_code"] in {s["store_id"] for s in route}]
    extract = [r for r in rows if r["year_month"] in focus]
    history = [
        dict(r, yago=number(r["yago"]), rr=number(r["rr"]))
        for r in rows
        if r["store_code"] is None or not re.search("ZOOM|ADJ", r["store_code"])
    ]
    if profile.active_months:
        recent = last_months(history, profile.active_months)
        active = {r["store_code"] for r in history if r["year_month"] in recent}
        history, extract = ([r for r in part if r["store_code"] in active] for part in (history, extract))
    counters = {
        p["pos_code"]
        for p in usable_pos(pos)
        if "COUNTER" in (p["pos_desc"] or "").upper() or "COUNTER" in (p["sales_rep_name"] or "").upper()
    }
    products = {"S_" + p["material"] for p in restricted} if profile.restricted_skus else set()

    def finish(part):
        kept = [
            r
            for r in part
            if outlet_of(r["store_code"]).replace(">", "_") not in counters
            and not (r["product_sku_code"] in products and r["bucket"] not in ("Pharmacy", "WSPharmacy"))
        ]
        return {tuple("Others" if n == "category_desc" and r[n] is None else r[n] for n in NAMES) for r in kept}

    return finish(history), finish(extract)


def all_regions(rows, pos, restricted, route, profile, unmatched="literal_na"):
    history, extract = set(), set()
    for region in sorted({r["region"] for r in rows if r["region"]}):
        part = one_region([r for r in rows if r["region"] == region], pos, restricted, route, profile, unmatched)
        history |= part[0]
        extract |= part[1]
    return history, extract
