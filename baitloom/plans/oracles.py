"""SQL for the queries, written base by base where the operators work on runs."""

from __future__ import annotations

from .tables import LETTERS_FROM, LETTERS_TO

_BASE = f"regexp_replace(translate(text, '{LETTERS_FROM}', '{LETTERS_TO}'), '[^ACGTNRY]', '', 'g')"


def _tiles(source: str, ident: str, prefix: str, most: int = 10) -> str:
    return f"""SELECT '{prefix}_' || {ident} || '_piece_' || row_number() OVER (PARTITION BY {ident} ORDER BY s) AS probe_id, seq FROM (
      SELECT {ident}, s, substr(seq, s + 1, 120) AS seq FROM (
        SELECT {ident}, seq, unnest(list_distinct(list_concat(range(0, length(seq) - 119, 120), [length(seq) - 120]))) AS s FROM {source} WHERE length(seq) >= 120))
      WHERE length(translate(seq, 'ACGTacgt', '')) <= {most}"""


def _aln(a: int, b: int) -> str:
    return f"""SELECT 'p' || (target_id % 50) || '_' || i AS probe_id, target_id, CAST(80 + (target_id * 3 + i * 11) % 21 AS DOUBLE) AS pident, CAST(len AS INT) AS length,
        CAST(CASE WHEN (target_id + i) % 3 = 0 THEN s + len ELSE s + 1 END AS INT) AS sstart, CAST(CASE WHEN (target_id + i) % 3 = 0 THEN s + 1 ELSE s + len END AS INT) AS send
      FROM (SELECT *, least(60 + (target_id * 7 + i * 13) % 61, n - s) AS len FROM (
        SELECT target_id, n, i, (target_id * {a} + i * {b}) % (n - 99) AS s FROM (SELECT target_id, length(seq) AS n, unnest(range(0, 10)) AS i FROM k)))"""


def _per_base(aln: str) -> str:
    return f"""SELECT p.target_id, p.p, p.base, CAST(coalesce(c.depth, 0) AS INT) AS depth FROM letters p LEFT JOIN (
        SELECT target_id, p, count(*) AS depth FROM (SELECT target_id, unnest(range(least(sstart, send) - 1, greatest(sstart, send))) AS p FROM {aln} WHERE pident >= 85 AND length >= 90) GROUP BY 1, 2) c
      ON p.target_id = c.target_id AND p.p = c.p"""


def _runs(source: str, key: str = "depth") -> str:
    return f"""SELECT target_id, CAST(min(p) AS INT) AS "start", CAST(max(p) + 1 AS INT) AS "end", {key} FROM (
        SELECT target_id, p, {key}, p - row_number() OVER (PARTITION BY target_id, {key} ORDER BY p) AS island FROM {source}) GROUP BY target_id, {key}, island"""


_PARTS = {
    "g": f"""SELECT doc_id AS target_id, source, lang, doc_id AS ord, CASE WHEN doc_id % 101 = 5 THEN translate(base, 'C', 'T') ELSE base END || repeat('A', CASE WHEN doc_id % 7 = 0 THEN CAST(4 + doc_id % 9 AS INT) ELSE 0 END) AS seq
      FROM (SELECT doc_id, source, lang, {_BASE} AS base FROM documents)""",
    "f": """SELECT target_id, source, ord, seq, n, cut, CASE WHEN nn / n > 0.05 THEN 'excess_n' WHEN odd / n >= 0.01 THEN 'nonstandard' WHEN n < 100 THEN 'too_short' WHEN nc / n < 0.01 THEN 'no_c' WHEN length(cut) < 100 THEN 'short_after_trim' ELSE 'keep' END AS reason
      FROM (SELECT *, CAST(length(seq) AS DOUBLE) AS n, length(seq) - length(translate(seq, 'Nn', '')) AS nn, length(translate(seq, 'ACGTNacgtn', '')) AS odd, length(seq) - length(translate(seq, 'Cc', '')) AS nc,
        regexp_replace(seq, '([^AaNnMm])[AaNnMm]{6,}$', '\\1') AS cut FROM g)""",
    "k": "SELECT target_id, source, cut AS seq FROM f WHERE reason = 'keep'",
    "bm": f"SELECT item_id, {_BASE} AS seq FROM benchmark",
    "panel": _tiles("bm", "item_id", "b"),
    "aln": _aln(37, 91),
    "aln2": _aln(41, 83),
    "letters": "SELECT target_id, unnest(range(0, length(seq))) AS p, unnest(string_split(seq, '')) AS base FROM k WHERE length(seq) > 0",
    "pb": _per_base("aln"),
    "pb2": _per_base("aln2"),
    "seg": _runs("pb"),
    "zero": "SELECT target_id, \"start\", \"end\" FROM seg WHERE depth = 0 AND \"end\" - \"start\" < 10",
    "sm": "SELECT pb.target_id, pb.p, base, CASE WHEN zero.target_id IS NOT NULL THEN 1 ELSE depth END AS depth FROM pb LEFT JOIN zero ON pb.target_id = zero.target_id AND p >= zero.\"start\" AND p < zero.\"end\"",
    "st": """SELECT target_id, (count(*) FILTER (depth = 0) - u) * 100.0 / nullif(t - u, 0) AS c0, count(*) FILTER (depth = 1) * 100.0 / nullif(t - u, 0) AS c1, count(*) FILTER (depth > 1) * 100.0 / nullif(t - u, 0) AS c_gt, avg(depth) AS meancov
      FROM (SELECT *, count(*) OVER (PARTITION BY target_id) AS t, count(*) FILTER (depth = 0 AND base = 'N') OVER (PARTITION BY target_id) AS u FROM sm) GROUP BY target_id, t, u""",
    "sc": "SELECT st.*, source AS cluster FROM st LEFT JOIN documents ON doc_id = target_id",
    "long": "SELECT target_id, cluster, 'c0' AS depth_class, c0 AS pct FROM sc UNION ALL SELECT target_id, cluster, 'c1', c1 FROM sc UNION ALL SELECT target_id, cluster, 'c_gt', c_gt FROM sc",
    "low": """SELECT target_id, seq, CASE WHEN b - a >= 120 THEN a ELSE least(greatest(a - CAST(floor((120 - (b - a)) / 2) AS INT), 0), n - 120) END AS s, b - a AS len, b, n FROM (
        SELECT r.target_id, "start" AS a, "end" AS b, seq, length(seq) AS n FROM seg r JOIN k USING (target_id) WHERE depth = 0 AND "end" - "start" > 20 AND length(seq) >= 120)""",
    "cov": "SELECT target_id, CASE WHEN count(*) FILTER (depth >= 1 OR base IN ('A', 'C', 'G', 'T')) = 0 THEN 0 ELSE count(*) FILTER (depth >= 1) * 100.0 / count(*) FILTER (depth >= 1 OR base IN ('A', 'C', 'G', 'T')) END AS coverage FROM pb GROUP BY 1",
    "pct": """SELECT p, round(avg(coverage), 2) AS value FROM (SELECT unnest([0, 0.05, 0.1, 0.25, 0.5, 0.75, 1]::DOUBLE[]) AS p) CROSS JOIN (SELECT coverage, row_number() OVER (ORDER BY coverage) - 1 AS r, count(*) OVER () AS n FROM cov)
      WHERE r IN (floor((n - 1) * p), ceil((n - 1) * p)) GROUP BY p""",
    "tiles": _tiles("k", "target_id", "x"),
    "props": "SELECT letter, count(*) AS n, count(*) * 1.0 / sum(count(*)) OVER () AS prop FROM (SELECT unnest(string_split(upper(seq), '')) AS letter FROM g WHERE length(seq) > 0) GROUP BY 1",
    "km": "SELECT target_id, CAST(pos AS INT) AS pos, kmer FROM (SELECT target_id, pos, substr(seq, pos + 1, 120) AS kmer FROM (SELECT target_id, upper(seq) AS seq, unnest(range(0, length(seq) - 119)) AS pos FROM k)) WHERE length(translate(kmer, 'ACGT', '')) = 0",
    "ks": "SELECT kmer, count(*) AS size FROM km GROUP BY 1",
    "nd": "SELECT l_orderkey AS o, r, l_orderkey || '_' || r AS id, translate(CAST(l_partkey AS VARCHAR), '0123456789', 'ACGTACGTAC') AS seq, l_partkey, CASE WHEN l_suppkey % 23 = 0 THEN '-' ELSE '+' END AS orient FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem)",
    "ln": "SELECT a.id AS from_id, '+' AS from_orient, b.id AS to_id, b.orient AS to_orient FROM nd a JOIN nd b ON a.o = b.o AND b.r = a.r + 1 UNION ALL SELECT a.id, '+', b.id, b.orient FROM nd a JOIN nd b ON b.o = a.o + 1 AND b.r = 1 WHERE a.l_partkey % 17 = 0",
    "od": "SELECT from_id, count(*) AS c FROM ln WHERE from_orient = '+' GROUP BY 1",
    "ind": "SELECT to_id, count(*) AS c FROM ln WHERE to_orient = '+' GROUP BY 1",
    "mg": "SELECT ln.* FROM ln JOIN od ON ln.from_id = od.from_id AND od.c = 1 JOIN ind ON ln.to_id = ind.to_id AND ind.c = 1 WHERE from_orient = '+' AND to_orient = '+'",
    "ch": "SELECT from_id AS head, from_id AS id, 0 AS rank FROM mg WHERE from_id NOT IN (SELECT to_id FROM mg) UNION ALL SELECT head, mg.to_id, rank + 1 FROM ch JOIN mg ON mg.from_id = ch.id",
    "cho": "SELECT head, id, rank FROM (SELECT *, count(*) OVER (PARTITION BY head) AS m FROM (SELECT head, ch.id, rank FROM (SELECT *, max(rank) OVER (PARTITION BY head) AS last FROM ch) ch LEFT JOIN od ON od.from_id = ch.id WHERE NOT (rank = last AND coalesce(od.c, 0) = 1))) WHERE m > 1",
    "ps": "SELECT probe_id, '+' AS strand, seq FROM panel UNION ALL SELECT probe_id, '-', reverse(translate(seq, 'ACGTRYacgtry', 'TGCAYRtgcayr')) FROM panel",
    "pw": "SELECT * FROM (SELECT probe_id, strand, i AS p, substr(seq, i + 1, 13) AS w FROM (SELECT *, unnest(range(0, length(seq) - 12)) AS i FROM ps)) WHERE length(translate(w, 'ACGT', '')) = 0",
    "tw": "SELECT * FROM (SELECT target_id, i AS t, substr(seq, i + 1, 13) AS w FROM (SELECT target_id, seq, unnest(range(0, length(seq) - 12)) AS i FROM k)) WHERE w IN (SELECT w FROM pw)",
    "dg": "SELECT DISTINCT probe_id, strand, target_id, t - p AS diag FROM tw JOIN pw USING (w)",
    "xs": "SELECT dg.*, unnest(range(0, length(ps.seq))) AS x, unnest(string_split(ps.seq, '')) AS pb FROM dg JOIN ps USING (probe_id, strand)",
    "xm": "SELECT xs.*, CASE WHEN pb IN ('A', 'C', 'G', 'T') AND pb = base THEN 1 ELSE -2 END AS v, CASE WHEN pb IN ('A', 'C', 'G', 'T') AND pb = base THEN 1 ELSE 0 END AS eq FROM xs LEFT JOIN letters l ON l.target_id = xs.target_id AND l.p = diag + x",
    "xt": "SELECT *, sum(v) OVER w AS total, sum(v) OVER w - v AS before, sum(eq) OVER w AS matches FROM xm WINDOW w AS (PARTITION BY probe_id, strand, target_id, diag ORDER BY x)",
    "xg": "SELECT *, min(before) OVER (PARTITION BY probe_id, strand, target_id, diag ORDER BY x ROWS UNBOUNDED PRECEDING) AS least FROM xt",
    "xe": "SELECT * FROM (SELECT *, total - least AS score, row_number() OVER (PARTITION BY probe_id, strand, target_id, diag ORDER BY total - least DESC, x) AS rn FROM xg) WHERE rn = 1",
    "xb": "SELECT xe.probe_id, xe.strand, xe.target_id, xe.diag, xe.score, xe.x AS last, min(xt.x) AS first, any_value(xe.matches) - min_by(xt.matches - xt.eq, xt.x) AS same FROM xe JOIN xt ON xt.probe_id = xe.probe_id AND xt.strand = xe.strand AND xt.target_id = xe.target_id AND xt.diag = xe.diag AND xt.x <= xe.x AND xt.before = xe.least GROUP BY 1, 2, 3, 4, 5, 6",
    "xa": "SELECT *, diag + first + 1 AS low, diag + last + 1 AS high, same * 100.0 / (last - first + 1) AS pident FROM xb WHERE last - first + 1 >= 40 AND same * 100.0 / (last - first + 1) >= 85",
    "al": """SELECT x.probe_id, target_id, pident, CAST(last - first + 1 AS INT) AS length, CAST(last - first + 1 - same AS INT) AS mismatch, 0 AS gapopen,
        CAST(CASE strand WHEN '+' THEN first + 1 ELSE length(p.seq) - last END AS INT) AS qstart, CAST(CASE strand WHEN '+' THEN last + 1 ELSE length(p.seq) - first END AS INT) AS qend,
        CAST(CASE strand WHEN '+' THEN low ELSE high END AS INT) AS sstart, CAST(CASE strand WHEN '+' THEN high ELSE low END AS INT) AS send, CAST(score AS INT) AS score
      FROM xa x JOIN panel p USING (probe_id) WHERE NOT EXISTS (SELECT 1 FROM xa g WHERE g.probe_id = x.probe_id AND g.strand = x.strand AND g.target_id = x.target_id AND g.diag <> x.diag
        AND g.first <= x.first AND g.last >= x.last AND g.low <= x.low AND g.high >= x.high AND g.score >= x.score)""",
    "pbc": _per_base("al"),
    "segc": _runs("pbc"),
}
_NEEDS = {
    "f": "g", "k": "f", "panel": "bm", "aln": "k", "aln2": "k", "letters": "k", "pb": "letters aln", "pb2": "letters aln2", "seg": "pb", "zero": "seg", "sm": "pb zero", "st": "sm", "sc": "st", "long": "sc", "low": "seg k",
    "cov": "pb", "pct": "cov", "tiles": "k", "props": "g", "km": "k", "ks": "km", "ln": "nd", "od": "ln", "ind": "ln", "mg": "ln od ind", "ch": "mg", "cho": "ch od", "ps": "panel", "pw": "ps", "tw": "k pw", "dg": "tw pw",
    "xs": "dg ps", "xm": "xs letters", "xt": "xm", "xg": "xt", "xe": "xg", "xb": "xe xt", "xa": "xb", "al": "xa panel", "pbc": "letters al", "segc": "pbc",
}
_STORED = {"g", "f", "k", "letters", "pb", "seg", "sm", "st", "mg", "ch", "dg", "xt", "xa", "pbc", "segc", "al"}


def _with(needs: str, body: str, **swap: str) -> str:
    """A query over the parts that it needs, in order; swap gives parts another definition."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for x in (swap.get(f"{name}_needs") or _NEEDS.get(name, "")).split():
                add(x)
            order.append(name)

    for x in needs.split():
        add(x)
    parts = ",\n".join(f"{x} AS {'MATERIALIZED ' if x in _STORED else ''}({swap.get(x, _PARTS[x])})" for x in order)
    return f"WITH RECURSIVE {parts}\n{body}"


#: The panel's own capture in place of the placed alignments.
_CAPTURED = {"pb": _PARTS["pbc"], "pb_needs": "letters al"}
_SUMMARY = (
    " UNION ALL ".join(f"SELECT '{c}' AS metric, round(avg({c}), 6) AS mean, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(median({c}), 6) AS median FROM st" for c in ("c0", "c1", "c_gt", "meancov"))
    + " UNION ALL SELECT 'total_probes', count(*)::DOUBLE, NULL, NULL, NULL FROM panel UNION ALL SELECT 'failed_genomes', (count(*) FILTER (c0 > 1))::DOUBLE, NULL, NULL, NULL FROM st"
)
_STATS = "round(c0, 6) AS c0, round(c1, 6) AS c1, round(c_gt, 6) AS c_gt, round(meancov, 6) AS meancov"
_SHARES = ", ".join(f"round(count(*) FILTER (depth = {d}) * 100.0 / count(*), 2) AS depth_{d}" for d in range(5)) + ", round(count(*) FILTER (depth >= 5) * 100.0 / count(*), 2) AS depth_5plus"
_RANKS = ", ".join(f"(SELECT value FROM pct WHERE p = {p}) AS cov_{c}" for p, c in ((0, "min"), (0.05, "5"), (0.1, "10"), (0.25, "q1"), (0.5, "med"), (0.75, "q3"), (1, "max")))
_COV = "CASE WHEN count(*) FILTER (depth >= {0} OR base IN ('A', 'C', 'G', 'T')) = 0 THEN 0 ELSE count(*) FILTER (depth >= {0}) * 100.0 / count(*) FILTER (depth >= {0} OR base IN ('A', 'C', 'G', 'T')) END"
_CHOICES = {"R": "AG", "K": "GT", "S": "GC", "Y": "CT", "M": "AC", "W": "AT", "B": "CGT", "H": "ACT", "D": "AGT", "V": "ACG", "N": "ATCT"}
_PICK = " ".join(
    f"WHEN '{code}' THEN CASE " + " ".join(f"WHEN u * ({' + '.join('w_' + x for x in letters)}) < {' + '.join('w_' + x for x in letters[: i + 1])} THEN '{letters[i]}'" for i in range(len(letters) - 1)) + f" ELSE '{letters[-1]}' END" for code, letters in _CHOICES.items()
)
_CHAINED = "SELECT head, string_agg(x.id, '|' ORDER BY rank) AS id, string_agg(nd.seq, '' ORDER BY rank) AS seq FROM {0} x JOIN nd ON nd.id = x.id GROUP BY head"

ORACLES: dict[str, str] = {
    "f1_dedup_by_id": _with("g", "SELECT source, target_id, md5(seq) AS seq_md5 FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ord DESC) AS n FROM g) WHERE n = 1"),
    "f2_composition_per_seq": _with("g", "SELECT target_id, letter, n, round(n * 1.0 / length(seq), 6) AS prop FROM (SELECT target_id, letter, count(*) AS n FROM (SELECT target_id, unnest(string_split(upper(seq), '')) AS letter FROM g WHERE length(seq) > 0) GROUP BY 1, 2) JOIN g USING (target_id)"),
    "f3_composition_overall": _with("props", "SELECT letter, coalesce(n, 0) AS n, round(coalesce(prop, 0), 6) AS prop FROM props FULL JOIN (SELECT unnest(['A', 'C', 'G', 'T', 'N']) AS letter) USING (letter)"),
    "f4_qc_flag": _with("f", "SELECT target_id, reason, CAST(length(seq) - length(cut) AS INT) AS trimmed_bp FROM f"),
    "f5_strip_tail": _with("f", "SELECT target_id, md5(cut) AS seq_md5 FROM f"),
    "f6_qc_report": _with("f", "SELECT reason, count(*) AS n, count(*) FILTER (length(seq) > length(cut)) AS trimmed FROM f GROUP BY 1"),
    "f6_qc_filter": _with("k", "SELECT target_id, md5(seq) AS seq_md5 FROM k"),
    "f7_ambiguous_count": _with("g", "SELECT target_id, CAST(length(regexp_replace(seq, '[ACGTacgt]', '', 'g')) AS INT) AS ambiguous FROM g"),
    "f8_tile": _with("tiles", "SELECT * FROM tiles"),
    "f9_pad_short": _with("g", "SELECT 'x_' || target_id || '_padded_probe' AS probe_id, lpad(s, 120, 'T') AS seq FROM (SELECT target_id, regexp_replace(seq, '[Nn]', '', 'g') AS s FROM g WHERE length(seq) < 120) WHERE length(s) >= 90"),
    "f10_substitute_ambiguous": _with(
        "tiles props",
        f"""SELECT probe_id, string_agg(CASE x {_PICK} ELSE x END, '' ORDER BY i) AS seq FROM (
          SELECT probe_id, i, x, CAST('0x' || substr(md5('1|' || probe_id || '|' || i), 1, 8) AS UBIGINT) / 4294967296.0 AS u FROM (
            SELECT probe_id, unnest(range(0, length(seq))) AS i, unnest(string_split(upper(seq), '')) AS x FROM tiles))
          CROSS JOIN (SELECT {', '.join(f"coalesce(max(prop) FILTER (letter = '{x}'), 0) AS w_{x}" for x in 'ACGT')} FROM props) GROUP BY probe_id""",
    ),
    "f11_enum_kmers": _with("km", "SELECT target_id, pos, md5(kmer) AS kmer_md5 FROM km"),
    "f12_reverse_complement": _with("g", "SELECT target_id, md5(reverse(translate(seq, 'ACGTRY', 'TGCAYR'))) AS seq_md5 FROM g"),
    "f13_length_band": _with("k", "SELECT target_id, CAST(length(seq) AS INT) AS n, m AS median_len FROM k, (SELECT median(length(seq)) AS m FROM k) WHERE length(seq) > m * (1 - 0.1) AND length(seq) < m * (1 + 0.1)"),
    "f14_length_normalised_profile": _with(
        "seg k",
        'SELECT target_id, round(("start" + 1) / length(seq) * m, 6) AS x_start, round("end" / length(seq) * m, 6) AS x_end, depth FROM seg JOIN k USING (target_id), (SELECT median(length(seq)) AS m FROM k) WHERE length(seq) > m * (1 - 0.1) AND length(seq) < m * (1 + 0.1)',
    ),
    "f15_sample_targets": _with("k", "SELECT target_id FROM (SELECT target_id, row_number() OVER (ORDER BY substr(md5('1|' || target_id), 1, 8), target_id) AS r, count(*) OVER () AS n FROM k) WHERE n <= 500 OR r <= 400"),
    "j1_align_probes": _with("al", "SELECT probe_id, target_id, round(pident, 6) AS pident, length, mismatch, gapopen, qstart, qend, sstart, send, score FROM al WHERE pident >= 85 AND length >= 40"),
    "j2_filter_alignments": _with("aln", "SELECT * FROM aln WHERE pident >= 85 AND length >= 90"),
    "j3_alignments_to_depth": _with("seg", "SELECT * FROM seg"),
    "j4_merge_capture": _with("pb pb2", _runs("(SELECT a.target_id, a.p, a.depth + b.depth AS depth FROM pb a JOIN pb2 b ON a.target_id = b.target_id AND a.p = b.p)")),
    "j5_remove_existing": _with("km tiles", "SELECT DISTINCT md5(kmer) AS kmer_md5 FROM km WHERE kmer NOT IN (SELECT seq FROM tiles)"),
    "j6_attach_clusters": _with("sc", f"SELECT target_id, {_STATS}, cluster FROM sc"),
    "j7_members_to_sequences": _with("g", "SELECT source AS cluster, 'genome_' || lpad(CAST(target_id AS VARCHAR), 12, '0') AS id, ord, CAST(length(seq) AS INT) AS n FROM g"),
    "j8_mergeable_links": _with("mg", "SELECT * FROM mg"),
    "j9_unmerged_sequences": _with("nd cho", "SELECT id, seq FROM nd WHERE id NOT IN (SELECT id FROM cho)"),
    "w1_depth_from_events": _with(
        "letters aln",
        " UNION ALL ".join(
            f"""SELECT *, '{s}' AS strand FROM ({_runs(f"(SELECT l.target_id, l.p, CAST(coalesce(c.d, 0) AS INT) AS depth FROM letters l LEFT JOIN (SELECT target_id, p, count(*) AS d FROM (SELECT target_id, unnest(range(least(sstart, send) - 1, greatest(sstart, send))) AS p FROM aln WHERE {w}) GROUP BY 1, 2) c ON c.target_id = l.target_id AND c.p = l.p)")})"""
            for s, w in (("+", "sstart <= send"), ("-", "sstart > send"))
        ),
    ),
    "w2_smooth_short_zeros": _with("sm", _runs("sm")),
    "w3_low_coverage": _with(
        "low",
        """SELECT target_id || '_position_' || (s + 1) || '_to_' || e AS id, target_id, CAST(s AS INT) AS "start", CAST(e AS INT) AS "end", md5(CASE WHEN len < 120 THEN upper(substr(seq, s + 1, e - s)) ELSE substr(seq, s + 1, e - s) END) AS seq_md5
        FROM (SELECT *, CASE WHEN len >= 120 THEN b ELSE s + 120 END AS e FROM low)""",
    ),
    "w4_coalesce_runs": _with("pb", _runs("(SELECT target_id, p, depth > 1 AS deep FROM pb)", "deep")),
    "w5_pick_representatives": _with("g", "SELECT source AS cluster, target_id AS id, CAST(length(seq) AS INT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(seq) - length(translate(seq, 'Nn', '')), length(seq) DESC, ord) AS r FROM g) WHERE r = 1"),
    "a1_genome_depth_stats": _with("st", f"SELECT target_id, {_STATS} FROM st"),
    "a2_panel_summary": _with("st panel", _SUMMARY),
    "a3_coverage_at_depth": _with("pb", f"SELECT target_id, round({_COV.format(2)}, 6) AS coverage FROM pb GROUP BY 1"),
    "a4_coverage_percentiles": _with("pct", "SELECT * FROM pct"),
    "a5_panel_depth_distribution": _with("pb", f"SELECT {_SHARES} FROM pb"),
    "a6_summary_report": _with(
        "pb pct",
        "SELECT 'panel' AS name, (SELECT count(DISTINCT target_id) FROM pb) AS total_targets, "
        + ", ".join(f"(SELECT value FROM pct WHERE p = {p}) AS {c}" for p, c in zip(("0", "0.05", "0.1", "0.25", "0.5", "0.75", "1"), ("cov_min", "cov_5", "cov_10", "cov_q1", "cov_med", "cov_q3", "cov_max"), strict=True))
        + f", * FROM (SELECT {_SHARES} FROM pb)",
    ),
    "a7_long_report": _with(
        "pb",
        "SELECT 'panel' AS name, target_id, count(*) AS length, count(*) FILTER (base IN ('A', 'C', 'G', 'T')) AS atgcs, round(count(*) FILTER (base IN ('A', 'C', 'G', 'T')) * 100.0 / count(*), 2) AS pct_atgcs, "
        + ", ".join(f"count(*) FILTER (depth = {d}) AS bases_{d}x" for d in range(5))
        + ", count(*) FILTER (depth >= 5) AS bases_5plusx, "
        + ", ".join(f"round({_COV.format(d)}, 1) AS cov_{d}x" for d in range(1, 6))
        + " FROM pb GROUP BY target_id",
    ),
    "a8_mapped_probe_count": _with("aln", "SELECT count(DISTINCT probe_id) AS mapped_probes FROM aln WHERE pident >= 85 AND length >= 90"),
    "a9_panel_counts": _with("panel ks", "SELECT count(*) AS total, count(*) FILTER (contains(id, '_round_')) AS added FROM (SELECT probe_id AS id FROM panel UNION ALL SELECT * FROM (SELECT 'x_round_3_probe_' || row_number() OVER (ORDER BY size DESC, kmer) FROM ks ORDER BY size DESC, kmer LIMIT 50))"),
    "a10_cluster_sizes": _with("sc", "SELECT cluster, count(*) AS genomes FROM sc GROUP BY 1"),
    "a11_depth_class_long": _with("long", "SELECT target_id, cluster, depth_class, round(pct, 6) AS pct FROM long"),
    "a12_boxplot_stats": _with("long", "SELECT depth_class, cluster, round(quantile_cont(pct, 0.25), 6) AS q1, round(quantile_cont(pct, 0.5), 6) AS med, round(quantile_cont(pct, 0.75), 6) AS q3, round(min(pct), 6) AS low, round(max(pct), 6) AS high, count(*) AS n FROM long GROUP BY 1, 2"),
    "a13_low_coverage_bases": _with("low", "SELECT CAST(coalesce(sum(greatest(len, 120)), 0) AS BIGINT) AS bases, CAST(floor(coalesce(sum(greatest(len, 120)), 0) / 120 * 0.3) AS BIGINT) AS batch_size FROM low"),
    "a14_kmer_support": _with("km", "SELECT md5(kmer) AS kmer_md5, count(*) AS size FROM km GROUP BY kmer"),
    "t1_rank_candidates": _with("ks", "SELECT 'x_probe_' || row_number() OVER (ORDER BY size DESC, kmer) AS probe_id, md5(kmer) AS seq_md5 FROM ks"),
    "t2_take_top": _with("ks", "SELECT 'x_probe_' || row_number() OVER (ORDER BY size DESC, kmer) AS probe_id, kmer AS seq FROM ks ORDER BY size DESC, kmer LIMIT 100"),
    "u1_append_probes": _with("tiles g panel", "SELECT * FROM tiles UNION ALL SELECT 'x_' || target_id || '_padded_probe', lpad(s, 120, 'T') FROM (SELECT target_id, regexp_replace(seq, '[Nn]', '', 'g') AS s FROM g WHERE length(seq) < 120) WHERE length(s) >= 90 UNION ALL SELECT * FROM panel"),
    "u2_merged_pangenome": _with("nd ch", f"SELECT md5(id) AS id, CAST(length(seq) AS INT) AS n FROM ({_CHAINED.format('ch')}) UNION ALL SELECT md5(id), CAST(length(seq) AS INT) FROM nd WHERE id NOT IN (SELECT id FROM ch)"),
    "u3_shared_targets": _with("k", "SELECT coalesce(k.target_id, doc_id) AS target_id, CASE WHEN doc_id IS NULL THEN 'left' WHEN k.target_id IS NULL THEN 'right' ELSE 'both' END AS side FROM k FULL JOIN documents ON doc_id = k.target_id"),
    "g1_merge_linear_chains": _with("nd cho", f"SELECT id, seq FROM ({_CHAINED.format('cho')}) UNION ALL SELECT id, seq FROM nd WHERE id NOT IN (SELECT id FROM cho)"),
    "g8_capture": _with("segc", "SELECT * FROM segc"),
    "g9_evaluate": _with("st panel", _SUMMARY, **_CAPTURED),
    "evaluate_panel": _with("sc", f"SELECT target_id, {_STATS}, cluster FROM sc", **_CAPTURED),
    "s1_read_fasta": _with("k", "SELECT CAST(target_id AS VARCHAR) AS id, target_id || ' of ' || source AS header, md5(seq) AS seq_md5 FROM k"),
    "s2_read_capture": _with("sm", "SELECT CAST(target_id AS VARCHAR) AS target_id, md5(string_agg(base, '' ORDER BY p)) AS seq_md5, md5(string_agg(depth, ',' ORDER BY p)) AS depth_md5 FROM sm GROUP BY 1"),
    "s3_read_alignments": _with("aln", "SELECT probe_id, CAST(target_id AS VARCHAR) AS target_id, pident, length, sstart, send FROM aln"),
    "s4_read_clusters": "SELECT CAST(doc_id AS VARCHAR) AS id, source AS cluster FROM documents",
    "s5_read_gfa_links": _with("ln", "SELECT * FROM ln"),
    "s6_write_fasta": _with("panel", "SELECT '>' || probe_id AS line FROM panel UNION ALL SELECT seq FROM panel"),
    "s7_write_capture": _with("pb", "SELECT md5('>' || target_id) AS line_md5 FROM (SELECT DISTINCT target_id FROM pb) UNION ALL SELECT md5('$' || string_agg(base, '' ORDER BY p)) FROM pb GROUP BY target_id UNION ALL SELECT md5('#' || string_agg(depth, ',' ORDER BY p)) FROM pb GROUP BY target_id"),
    "s8_write_stats_csv": _with("cov", "SELECT target_id || ',' || printf('%.3f', round(coverage, 2)) AS line FROM cov"),
    "s9_write_report_tsv": _with("pct pb", f"SELECT 'panel' AS name, {', '.join(f'{x} AS {x}' for x in (f'depth_{d}' for d in range(5)))}, depth_5plus, total_targets, {_RANKS} FROM (SELECT {_SHARES}, count(DISTINCT target_id)::DOUBLE AS total_targets FROM pb)"),
}

# The same results by another way of reading.
ORACLES |= {
    "s1_read_fasta_pieces": _with("k", "SELECT CAST(target_id AS VARCHAR) AS target_id, CAST(x AS INT) AS \"at\", md5(substr(seq, x + 1, 500)) AS piece_md5 FROM (SELECT target_id, seq, unnest(range(0, length(seq), 500)) AS x FROM k)"),
    "f8_tile_pieces": ORACLES["f8_tile"],
    "g8_capture_pieces": ORACLES["g8_capture"],
    "s2_read_capture_runs": ORACLES["w2_smooth_short_zeros"],
    "s4_read_clusters_cdhit": ORACLES["s4_read_clusters"],
    "j4_merge_files": ORACLES["j4_merge_capture"],
}
