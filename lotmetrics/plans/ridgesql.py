"""SQL of the ridge regressions, for any number of features."""


def ridge(p: int, least: int, lam: str, tag: str = "", source: str = "tr") -> str:
    """CTEs from source(key, x1..xp, y, w) to fit{tag}(key, b0..bp, lo1..hip) of standardised ridge regression; lam is relative to the rows.

    The normal equations are solved by elimination, one CTE a feature; the penalty keeps pivots away from 0.
    """
    xs = range(1, p + 1)
    pairs = [(i, j) for i in xs for j in xs if i <= j]
    means = ", ".join(f"sum(w * x{i}) / sum(w) m{i}, min(x{i}) lo{i}, max(x{i}) hi{i}" for i in xs)
    out = [f"mo{tag} as (select key, {means}, sum(w * y) / sum(w) my from {source} group by 1 having count(*) >= {least})"]
    second = ", ".join([f"sum(w * (x{i} - m{i}) * (x{j} - m{j})) / sum(w) c{i}_{j}" for i, j in pairs] + [f"sum(w * (x{i} - m{i}) * (y - my)) / sum(w) d{i}" for i in xs])
    out.append(f"cv{tag} as (select key, {second} from {source} join mo{tag} using (key) group by 1)")
    out.append(f"sd{tag} as (select *, {', '.join(f'case when c{i}_{i} < 1e-24 then 1 else sqrt(c{i}_{i}) end s{i}' for i in xs)} from cv{tag})")
    out.append(f"st{tag}_0 as (select key, {', '.join(f's{i}' for i in xs)}, {', '.join(f'c{i}_{j} / (s{i} * s{j})' + (f' + {lam}' if i == j else '') + f' a{i}_{j}' for i, j in pairs)}, {', '.join(f'd{i} / s{i} r{i}' for i in xs)} from sd{tag})")
    for k in range(1, p):
        changed = [f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k} a{i}_{j}" for i, j in pairs if i > k] + [f"r{i} - a{k}_{i} * r{k} / a{k}_{k} r{i}" for i in xs if i > k]
        kept = [f"a{i}_{j}" for i, j in pairs if i <= k] + [f"r{i}" for i in xs if i <= k] + [f"s{i}" for i in xs]
        out.append(f"st{tag}_{k} as (select key, {', '.join(changed + kept)} from st{tag}_{k - 1})")
    last = f"st{tag}_{p - 1}"
    for k in reversed(xs):
        rest = "".join(f" - a{k}_{j} * z{j}" for j in xs if j > k)
        out.append(f"z{tag}_{k} as (select *, (r{k}{rest}) / a{k}_{k} z{k} from {last})")
        last = f"z{tag}_{k}"
    slopes = ", ".join(f"z{i} / s{i} b{i}" for i in xs)
    out.append(f"fit{tag} as (select key, {', '.join(f'lo{i}, hi{i}, b{i}' for i in xs)}, my - {' - '.join(f'b{i} * m{i}' for i in xs)} b0 from mo{tag} join (select key, {slopes} from {last}) using (key))")
    return ", ".join(out)


def predicted(p: int, fit: str = "fit", rows: str = "fr") -> str:
    """The prediction of a row with x1..xp, each held to the range of the training rows."""
    whole = " and ".join(f"{rows}.x{i} is not null" for i in range(1, p + 1))
    total = " + ".join(f"{fit}.b{i} * least(greatest({rows}.x{i}, {fit}.lo{i}), {fit}.hi{i})" for i in range(1, p + 1))
    return f"(case when {whole} then {fit}.b0 + {total} end)"


def known(p: int, fr: str = "fr", to: str = "tr", weight: str = "1e0", extra: str = "") -> str:
    """The training rows of every horizon and origin of fr(h, origin, x.., y): those whose outcome was known then, of complete features."""
    xs = ", ".join(f"x{i}" for i in range(1, p + 1))
    full = " and ".join(f"x{i} is not null" for i in range(1, p + 1))
    return f"{to} as (select {extra}o.h * 100000 + o.origin as key, {xs}, y, {weight} w from (select distinct h, origin from {fr}) o join {fr} on {fr}.h = o.h and {fr}.origin + {fr}.h <= o.origin where {full} and y is not null)"
