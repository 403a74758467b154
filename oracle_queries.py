"""Plain SQL for every registered query, written independently of the DataFrame operators.

Each query is a final SELECT over the common table expressions it names; ``build`` puts those it
needs, and what they need, in front.
"""

from __future__ import annotations

import re

GOOD = "".join(chr(53 + i) for i in range(21)) * 4
BAD = "".join(chr(38 + i % 8) for i in range(60))


def q(text: str) -> str:
    return text.replace("'", "''")


def base_ctes(mixed: bool, copies: bool) -> dict[str, str]:
    """Inputs derived from the test tables."""
    even = "CASE WHEN {p} % 2 = 0 THEN 'GRCh38_' ELSE 'GRCm39_' END" if mixed else "''"
    own = "(l_partkey + (hi - 1) * 13) % (SELECT count(*) FROM part)"
    pk = (
        f"CASE WHEN l_orderkey % 10 <> 3 THEN {own} - ({own}) % 2 + cell_no % 2 ELSE {own} END" if mixed else own
    )
    copy_cols = ", unnest(range(0, l_linenumber % 3 + 1)) AS copy" if copies else ""
    copy_name = "read_name || ':' || copy AS read_name" if copies else "read_name"
    return {
        "cellno": """
            SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                   CASE WHEN l_orderkey % 10 < 8 THEN l_suppkey % 100 ELSE 1000 + l_orderkey % 2000 END AS cell_no
            FROM lineitem""",
        "lines": """
            SELECT *,
                   CASE WHEN l_orderkey // 10 % 5 < 3 THEN 'S0' WHEN l_orderkey // 10 % 5 = 3 THEN 'S1'
                        ELSE 'S2' END AS sample,
                   concat_ws(':', 'R', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                             CAST(round(l_extendedprice * 100) AS BIGINT)) AS read_name,
                   array_to_string(list_transform(range(13), lambda i: substr('ACGT',
                       CAST((cell_no * 7919 + 12345) // CAST(pow(4, i) AS BIGINT) % 4 AS INTEGER) + 1, 1)), '') AS barcode
            FROM cellno""",
        "listed": "SELECT DISTINCT barcode, cell_no AS row_no FROM lines WHERE cell_no % 10 <> 9",
        "whitelist": """
            SELECT * FROM listed UNION ALL
            SELECT * FROM (SELECT translate(barcode[1:1], 'ACGT', 'CGTA') || barcode[2:] AS barcode, row_no + 100000 AS row_no
                           FROM listed WHERE row_no % 50 = 0) WHERE barcode NOT IN (SELECT barcode FROM listed)""",
        "raw1": """
            SELECT *, array_to_string(list_transform(range(60), lambda i: substr('ACGT',
                CAST((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7 + i * i * 13 + i * l_suppkey) % 97 % 4
                     AS INTEGER) + 1, 1)), '') AS s0
            FROM lines""",
        "raw2": """
            SELECT *, CASE WHEN l_orderkey % 9 = 0 THEN s0[1:30] || repeat('A', 18) || s0[49:] ELSE s0 END AS s1
            FROM raw1""",
        "raw3": """
            SELECT *, CASE WHEN l_orderkey % 11 = 0 THEN s1[1:46] || repeat('G', 14) ELSE s1 END AS s2 FROM raw2""",
        "raw4": """
            SELECT *, CASE WHEN l_orderkey % 23 = 0 THEN s2[1:9] || repeat('N', 7) || s2[17:] ELSE s2 END AS s3,
                   CASE WHEN l_orderkey % 19 = 0 THEN 11 ELSE 60 END AS len
            FROM raw3""",
        "reads": f"""
            SELECT sample, '@' || read_name || ' 1:N:0' AS header, read_name,
                   left(s3, len) AS r1_seq,
                   left(CASE WHEN l_orderkey % 29 = 0 THEN '{q(BAD)}'
                        ELSE substr('{q(GOOD)}', l_partkey % 21 + 1, 60) END, len) AS r1_qual,
                   CASE WHEN l_orderkey % 101 = 0 THEN barcode[1:9]
                        WHEN l_orderkey % 17 = 0 THEN barcode[1:2] || 'N' || barcode[4:8] || 'N' || barcode[10:]
                        WHEN l_orderkey % 13 = 0 THEN barcode[1:4] || 'N' || barcode[6:]
                        ELSE barcode END AS r2_seq,
                   substr('{q(GOOD)}', l_suppkey % 21 + 1, CASE WHEN l_orderkey % 101 = 0 THEN 9 ELSE 13 END) AS r2_qual
            FROM raw4""",
        "samples": "SELECT DISTINCT sample FROM lines UNION SELECT 'S9'",
        "genes": f"""
            SELECT p_partkey AS pk, 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS gene_id,
                   CASE WHEN p_partkey % 50 = 7 THEN 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0')
                        ELSE {even.format(p='p_partkey')} || p_name END AS gene_name,
                   {even.format(p='p_partkey')} ||
                     CASE WHEN p_partkey % 40 = 0 THEN 'MT' ELSE 'chr' || (p_partkey % 4 + 1) END AS chrom,
                   p_partkey // 4 * 400 + 1001 AS g_start, p_partkey // 4 * 400 + 1600 AS g_end,
                   CASE WHEN p_partkey // 4 % 3 = 0 THEN '-' ELSE '+' END AS strand
            FROM part""",
        "exons": """
            SELECT pk, gene_id, chrom, strand, g_start + o[1] AS g_start, g_start + o[2] AS g_end
            FROM (SELECT *, unnest([[0, 149], [250, 399], [470, 599]]) AS o FROM genes)""",
        "hits": f"""
            SELECT *, unnest(range(1, nh + 1)) AS hi FROM (
                SELECT *, CASE WHEN l_orderkey % 7 = 0 THEN 2 + l_linenumber % 2 ELSE 1 END AS nh{copy_cols} FROM lines)""",
        "placed": f"""
            SELECT * EXCLUDE (read_name), {copy_name}, {pk} AS pk FROM hits""",
        "alignments": f"""
            SELECT sample, read_name || '_' || barcode || '_' AS read_name, pk, hi, nh,
                   ((CASE WHEN pk // 4 % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN l_quantity % 11 = 0 THEN 1 ELSE 0 END) % 2) AS rev,
                   ((CASE WHEN pk // 4 % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN l_quantity % 11 = 0 THEN 1 ELSE 0 END) % 2) * 16
                     + CASE WHEN hi > 1 THEN 256 ELSE 0 END AS flag,
                   {even.format(p='pk')} || CASE WHEN pk % 40 = 0 THEN 'MT' ELSE 'chr' || (pk % 4 + 1) END AS chrom,
                   pk // 4 * 400 + 1001 + (l_orderkey * 53 + l_linenumber * 101) % 700 - 60 AS pos,
                   CASE WHEN nh = 1 THEN 255 ELSE 3 END AS mapq,
                   l_orderkey % 29 = 0 AS spliced,
                   CAST(l_quantity % 5 AS INTEGER) AS nm
            FROM placed""",
        "blocks": """
            SELECT sample, read_name, hi, chrom, CASE WHEN rev = 1 THEN '-' ELSE '+' END AS strand,
                   pos AS b_start, CASE WHEN spliced THEN pos + 19 ELSE pos + 39 END AS b_end FROM alignments
            UNION ALL
            SELECT sample, read_name, hi, chrom, CASE WHEN rev = 1 THEN '-' ELSE '+' END, pos + 120, pos + 139
            FROM alignments WHERE spliced""",
        # bins of 1000 bases keep the interval joins small; a pair counts in its first shared bin
        "bbins": "SELECT *, unnest(range(b_start // 1000, b_end // 1000 + 1)) AS bin FROM blocks",
        "gbins": "SELECT *, unnest(range(g_start // 1000, g_end // 1000 + 1)) AS bin FROM genes",
        "ebins": "SELECT *, unnest(range(g_start // 1000, g_end // 1000 + 1)) AS bin FROM exons",
        "tx": """
            SELECT sample, read_name, hi, count(*) AS n, min(gene_id) AS g FROM (
                SELECT sample, read_name, hi, gene_id,
                       sum(least(b_end, g_end) - greatest(b_start, g_start) + 1) AS shared
                FROM bbins JOIN gbins USING (chrom, strand, bin)
                WHERE b_start <= g_end AND g_start <= b_end AND greatest(b_start, g_start) // 1000 = bin GROUP BY ALL)
            WHERE shared >= 20 GROUP BY ALL""",
        "ex": """
            SELECT sample, read_name, hi, count(*) AS n, min(gene_id) AS g FROM (
                SELECT sample, read_name, hi, gene_id,
                       sum(least(b_end, g_end) - greatest(b_start, g_start) + 1) AS shared
                FROM bbins JOIN ebins USING (chrom, strand, bin)
                WHERE b_start <= g_end AND g_start <= b_end AND greatest(b_start, g_start) // 1000 = bin GROUP BY ALL)
            WHERE shared >= 20 GROUP BY ALL""",
        "assigned": """
            SELECT a.*, coalesce(tx.n, 0) AS tx_n, CASE WHEN tx.n = 1 THEN tx.g || '.3' END AS tx_gene,
                   coalesce(ex.n, 0) AS ex_n, CASE WHEN ex.n = 1 THEN ex.g || '.3' END AS ex_gene
            FROM alignments a LEFT JOIN tx USING (sample, read_name, hi) LEFT JOIN ex USING (sample, read_name, hi)""",
        "multi": "SELECT * FROM assigned WHERE nh > 1 AND nm <= 3",
        "round1": """
            SELECT sample, read_name, count(DISTINCT tx_gene) AS genes, count_if(tx_n > 1) AS amb,
                   max(hi) FILTER (WHERE tx_n = 1) AS pick
            FROM multi GROUP BY ALL""",
        "open_reads": """
            SELECT m.* FROM multi m JOIN round1 r USING (sample, read_name)
            WHERE m.tx_n > 0 AND NOT (r.genes = 1 AND r.amb = 0)""",
        "round2": """
            SELECT sample, read_name, count(DISTINCT ex_gene) AS genes, count_if(ex_n > 1) AS amb,
                   max(hi) FILTER (WHERE ex_n = 1) AS pick
            FROM open_reads GROUP BY ALL""",
        "resolved1": """
            SELECT m.* EXCLUDE (nh, hi), 1 AS nh, 1 AS hi, tx_gene AS xt FROM multi m JOIN round1 r USING (sample, read_name)
            WHERE r.genes = 1 AND r.amb = 0 AND m.hi = r.pick""",
        "resolved2": """
            SELECT m.* EXCLUDE (nh, hi), 1 AS nh, 1 AS hi, ex_gene AS xt FROM open_reads m JOIN round2 r USING (sample, read_name)
            WHERE r.genes = 1 AND r.amb = 0 AND m.hi = r.pick""",
        "annotated": """
            SELECT *, tx_gene AS xt FROM assigned WHERE nh = 1 AND nm <= 3 AND tx_n = 1
            UNION ALL BY NAME
            SELECT *, ex_gene AS xt FROM assigned WHERE nh = 1 AND nm <= 3 AND tx_n > 1 AND ex_n = 1
            UNION ALL BY NAME SELECT * FROM resolved1
            UNION ALL BY NAME SELECT * FROM resolved2""",
        "deduped": """
            SELECT *, regexp_extract(read_name, '_([A-Z]+)_$', 1) AS bc FROM annotated
            QUALIFY row_number() OVER (
                PARTITION BY sample, chrom, rev,
                    CASE WHEN rev = 1 THEN pos + CASE WHEN spliced THEN 139 ELSE 39 END ELSE pos END,
                    regexp_extract(read_name, '_([A-Z]+)_$', 1)
                ORDER BY mapq DESC, nh, read_name) = 1""",
        "counts": """
            SELECT sample, bc AS barcode, split_part(xt, '.', 1) AS gene_id, count(*) AS n
            FROM deduped WHERE bc IN (SELECT barcode FROM whitelist) GROUP BY ALL""",
        "totals": f"""
            SELECT sample, barcode, CAST(sum(n) AS BIGINT) AS total_counts,
                   CAST(sum(CASE WHEN starts_with(gene_name, 'GRCh38_') THEN n ELSE 0 END) AS BIGINT) AS hsap_counts,
                   CAST(sum(CASE WHEN starts_with(gene_name, 'GRCm39_') THEN n ELSE 0 END) AS BIGINT) AS mmus_counts,
                   count(*) AS n_genes
            FROM counts JOIN genes USING (gene_id) GROUP BY ALL""",
        # one row per (sample, species, value) whose density is wanted
        "vals": (
            """
            SELECT sample, 'hsap' AS species, hsap_counts AS c FROM totals WHERE hsap_counts > mmus_counts
            UNION ALL SELECT sample, 'mmus', mmus_counts FROM totals WHERE mmus_counts > hsap_counts"""
            if mixed
            else "SELECT sample, 'all' AS species, total_counts AS c FROM totals"
        ),
        "shape": """
            SELECT sample, species, count(*) AS n, min(log10(c + 1)) AS lo, max(log10(c + 1)) AS hi,
                   pow(count(*), -0.2) * stddev_samp(log10(c + 1)) AS h
            FROM vals GROUP BY ALL HAVING count(DISTINCT c) > 1""",
        "curve": """
            SELECT sample, species, i, lo + i * ((hi - lo) / 199) AS x,
                   sum(exp(-0.5 * pow((lo + i * ((hi - lo) / 199) - log10(c + 1)) / h, 2)) / (n * h * sqrt(2 * pi()))) AS d
            FROM (SELECT *, unnest(range(200)) AS i FROM shape JOIN vals USING (sample, species)) GROUP BY ALL""",
        "minima": """
            SELECT * FROM (SELECT *, lag(d) OVER w AS before, lead(d) OVER w AS after FROM curve
                           WINDOW w AS (PARTITION BY sample, species ORDER BY i))
            WHERE d < before AND d < after AND x >= log10(21)""",
        "slopes": """
            SELECT *, (lead(f) OVER w - f) / (lead(x) OVER w - x) AS s FROM (
                SELECT *, (lead(d) OVER w - d) / (lead(x) OVER w - x) AS f FROM curve
                WINDOW w AS (PARTITION BY sample, species ORDER BY i))
            WINDOW w AS (PARTITION BY sample, species ORDER BY i)""",
        "diffs": """
            SELECT sample, species, i, x, first_derivative, second_derivative FROM (
                SELECT *, lag(f) OVER w AS first_derivative, lag(s) OVER w AS second_derivative FROM slopes
                WINDOW w AS (PARTITION BY sample, species ORDER BY i))
            WHERE second_derivative IS NOT NULL""",
        "turns": """
            SELECT * FROM (SELECT *, lag(second_derivative) OVER (PARTITION BY sample, species ORDER BY i) AS before FROM diffs)
            WHERE before * second_derivative < 0 AND x >= log10(21) AND abs(first_derivative) < 0.2""",
        "cutoffs": """
            SELECT s.sample, s.species,
                   CASE WHEN h.n IS NOT NULL THEN coalesce(
                       (SELECT min(x) FROM minima m WHERE m.sample = s.sample AND m.species = s.species),
                       (SELECT min(x) FROM turns t WHERE t.sample = s.sample AND t.species = s.species),
                       log10(21)) END AS cutoff
            FROM (SELECT DISTINCT sample, unnest(""" + ("['hsap', 'mmus']" if mixed else "['all']") + """) AS species FROM totals) s
            LEFT JOIN shape h USING (sample, species)""",
        "limits": """
            SELECT sample, species, cutoff,
                   CASE WHEN cutoff IS NULL THEN 20 ELSE CAST(round_even(pow(10, cutoff) - 1, 0) AS BIGINT) END AS threshold
            FROM cutoffs""",
        "cells": """
            SELECT t.*, threshold, total_counts >= threshold AS is_single_cell FROM totals t JOIN limits USING (sample)""",
        "limits2": """
            SELECT sample,
                   CASE WHEN count(cutoff) = 2 THEN max(threshold) FILTER (WHERE species = 'hsap') ELSE 20 END AS hsap_threshold,
                   CASE WHEN count(cutoff) = 2 THEN max(threshold) FILTER (WHERE species = 'mmus') ELSE 20 END AS mmus_threshold
            FROM limits GROUP BY sample""",
        "cells2": """
            SELECT *, is_single_cell AND NOT is_hsap_cell AS is_mmus_cell FROM (
                SELECT t.*, hsap_threshold, mmus_threshold,
                    hsap_counts >= hsap_threshold OR mmus_counts >= mmus_threshold AS is_called_cell,
                    (hsap_counts >= hsap_threshold AND mmus_counts <= mmus_threshold)
                      OR (hsap_counts <= hsap_threshold AND mmus_counts >= mmus_threshold) AS is_single_cell,
                    hsap_counts >= hsap_threshold AND mmus_counts <= mmus_threshold AS is_hsap_cell,
                    CASE WHEN hsap_counts > hsap_threshold AND mmus_counts > mmus_threshold THEN 'multiplet'
                         WHEN hsap_counts < hsap_threshold AND mmus_counts < mmus_threshold THEN 'noise'
                         ELSE 'single-cell' END AS barcode_type
                FROM totals t JOIN limits2 USING (sample))""",
        "rawreads": "SELECT sample, count(l.l_orderkey) AS raw_reads FROM samples LEFT JOIN lines l USING (sample) GROUP BY sample",
        # barcodes
        "variants": """
            SELECT barcode, position, barcode[1:position - 1] || b || barcode[position + 1:] AS variant, rank
            FROM (SELECT barcode, unnest(range(1, 14)) AS position FROM whitelist),
                 (VALUES ('N', 0), ('A', 1), ('C', 2), ('G', 3), ('T', 4)) AS v(b, rank)
            WHERE barcode[position] <> b""",
        "safe": "SELECT variant, min(barcode) AS barcode, min(position) AS position, min(rank) AS rank FROM variants GROUP BY variant HAVING count(*) = 1",
        "matched": """
            SELECT r.*, CASE WHEN length(r2_seq) >= 13 THEN r2_seq[1:13] END AS observed,
                   CASE WHEN length(r2_seq) >= 13 THEN coalesce(w.barcode, s.barcode) END AS barcode
            FROM reads r LEFT JOIN whitelist w ON w.barcode = r.r2_seq[1:13] AND length(r2_seq) >= 13
            LEFT JOIN safe s ON s.variant = r.r2_seq[1:13] AND length(r2_seq) >= 13""",
        "status": """
            SELECT *, CASE WHEN observed IS NULL THEN 'too_short' WHEN barcode IS NULL THEN 'failed'
                           WHEN observed = barcode THEN 'direct' ELSE 'corrected' END AS barcode_status FROM matched""",
        "qc1": "SELECT *, r1_seq[9:] AS s1, r1_qual[9:] AS q1 FROM status",
        "qc2": """
            SELECT *, regexp_replace(s1, '(A{10,}|C{10,}|G{10,}|T{10,})$', '') AS s2 FROM qc1""",
        "qc3": """
            SELECT *, left(q1, length(s2)) AS q2, regexp_extract(s2, '^(.*?)(A{15,}|A{13,}CG)', 1) AS head,
                   regexp_matches(s2, 'A{15,}|A{13,}CG') AS has_polya FROM qc2""",
        "qc4": """
            SELECT *, CASE WHEN has_polya THEN head ELSE s2 END AS s3q,
                list_sum(list_transform(string_split(q2, ''), lambda c: ascii(c) - 33)) AS qsum,
                length(regexp_replace(q2, '[^!-/]', '', 'g')) AS low FROM qc3""",
        "qc": """
            SELECT *, CASE WHEN lost_at IS NULL THEN s3q END AS out_seq,
                CASE WHEN lost_at IS NULL THEN left(q2, length(s3q)) END AS out_qual,
                reach_polyx AND length(s2) < length(s1) AS polyx_trimmed,
                reach_polya AND has_polya AS polya_trimmed
            FROM (SELECT *,
                CASE WHEN barcode IS NULL THEN 'barcode' WHEN length(s1) < 5 THEN 'sss'
                     WHEN length(s2) < 5 THEN 'polyx'
                     WHEN qsum < 15 * length(s2) OR low > 0.4 * length(s2) THEN 'quality'
                     WHEN length(regexp_replace(s2, '[^N]', '', 'g')) > 5 THEN 'n'
                     WHEN length(s3q) < 5 THEN 'polya' END AS lost_at,
                barcode IS NOT NULL AND length(s1) >= 5 AS reach_polyx,
                barcode IS NOT NULL AND length(s1) >= 5 AND length(s2) >= 5
                  AND NOT (qsum < 15 * length(s2) OR low > 0.4 * length(s2))
                  AND length(regexp_replace(s2, '[^N]', '', 'g')) <= 5 AS reach_polya
                FROM qc4)""",
        "cascade0": """
            SELECT sample, count(*) AS raw_reads, count_if(barcode_status = 'direct') AS barcode_direct_match,
                count_if(barcode_status = 'corrected') AS barcode_corrected, count_if(lost_at = 'barcode') AS barcode_failed,
                count_if(barcode IS NOT NULL) AS post_barcode_reads_retained,
                count_if(lost_at = 'sss') AS too_short_after_sss, count_if(reach_polyx) AS post_sss_trim_reads_retained,
                count_if(polyx_trimmed) AS polyx_trimmed_terminal, count_if(lost_at = 'polyx') AS polyx_too_short_after_trim,
                count_if(lost_at IS NULL OR lost_at IN ('quality', 'n', 'polya')) AS post_polyx_trim_reads_retained,
                count_if(lost_at = 'quality') AS low_quality_reads,
                count_if(lost_at IS NULL OR lost_at IN ('n', 'polya')) AS post_quality_filter_reads_retained,
                count_if(lost_at = 'n') AS too_many_n_reads, count_if(reach_polya) AS post_n_filter_reads_retained,
                count_if(polya_trimmed) AS polya_trimmed_internal, count_if(lost_at = 'polya') AS polya_too_short_after_trim,
                count_if(lost_at IS NULL) AS post_polya_trim_reads_retained, count_if(lost_at IS NULL) AS reads_output,
                CAST(sum(length(out_seq)) AS DOUBLE) / count_if(lost_at IS NULL) AS mean_read_length_post_QC,
                median(length(out_seq)) AS median_read_length_post_QC,
                CAST(sum(CASE WHEN lost_at IS NULL THEN length(regexp_replace(r1_seq[1:8], '[^GC]', '', 'g')) END) AS DOUBLE)
                  / (8 * count_if(lost_at IS NULL)) * 100 AS SSS_gc_perc,
                CAST(sum(length(regexp_replace(out_qual, '[^?-~]', '', 'g'))) AS DOUBLE) / sum(length(out_qual)) AS R1_output_Q30_rate,
                CAST(sum(CASE WHEN lost_at IS NULL THEN length(regexp_replace(r2_qual[1:13], '[^?-~]', '', 'g')) END) AS DOUBLE)
                  / (13 * count_if(lost_at IS NULL)) AS R2_barcode_Q30_rate
            FROM qc GROUP BY sample""",
        "profiled": """
            SELECT sample, 'R1 Pre-QC' AS kind, r1_seq AS seq, r1_qual AS qual FROM qc
            UNION ALL SELECT sample, 'R2 Pre-QC', r2_seq, r2_qual FROM qc
            UNION ALL SELECT sample, 'R1 Post-QC', out_seq, out_qual FROM qc WHERE lost_at IS NULL""",
        "positions": """
            SELECT sample, kind, i AS position, count(*) AS bases, sum(ascii(qual[i]) - 33) AS quality_sum,
                   count_if(seq[i] IN ('G', 'C')) AS gc, count_if(seq[i] = 'N') AS n
            FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM profiled) GROUP BY ALL""",
        # read distribution: tags against gene-level intervals
        "parts": """
            SELECT e.chrom, e.strand, e.g_start AS s, e.g_end AS e,
                   CASE WHEN e.pk % 2 = 0 THEN g.g_start + 30 ELSE g.g_start END AS c0,
                   CASE WHEN e.pk % 2 = 0 THEN g.g_start + 569 ELSE g.g_end END AS c1
            FROM exons e JOIN genes g USING (pk)""",
        "spans": """
            SELECT chrom, 'CDS_Exons' AS kind, greatest(s, c0) AS s, least(e, c1) AS e FROM parts
            UNION ALL SELECT chrom, CASE strand WHEN '+' THEN '5''UTR_Exons' ELSE '3''UTR_Exons' END, s, least(e, c0 - 1) FROM parts
            UNION ALL SELECT chrom, CASE strand WHEN '+' THEN '3''UTR_Exons' ELSE '5''UTR_Exons' END, greatest(s, c1 + 1), e FROM parts
            UNION ALL SELECT chrom, 'Introns', g_start + 150, g_start + 249 FROM genes
            UNION ALL SELECT chrom, 'Introns', g_start + 400, g_start + 469 FROM genes
            UNION ALL SELECT chrom, CASE strand WHEN '+' THEN 'TSS_up_' ELSE 'TES_down_' END || k || 'kb',
                greatest(1, g_start - k * 1000), g_start - 1 FROM genes, (VALUES (1), (5), (10)) AS v(k)
            UNION ALL SELECT chrom, CASE strand WHEN '+' THEN 'TES_down_' ELSE 'TSS_up_' END || k || 'kb',
                g_end + 1, g_end + k * 1000 FROM genes, (VALUES (1), (5), (10)) AS v(k)""",
        "spots": """
            SELECT chrom, kind, unnest(range(s, e + 1)) AS loc FROM (SELECT DISTINCT * FROM spans WHERE e >= s)""",
        "flags": """
            SELECT chrom, loc, bool_or(kind = 'CDS_Exons') AS cds, bool_or(kind = '5''UTR_Exons') AS u5,
                   bool_or(kind = '3''UTR_Exons') AS u3, bool_or(kind = 'Introns') AS intron,
                   bool_or(kind = 'TSS_up_1kb') AS t1, bool_or(kind = 'TSS_up_5kb') AS t5, bool_or(kind = 'TSS_up_10kb') AS t10,
                   bool_or(kind = 'TES_down_1kb') AS e1, bool_or(kind = 'TES_down_5kb') AS e5, bool_or(kind = 'TES_down_10kb') AS e10
            FROM spots GROUP BY ALL""",
        "pure": """
            SELECT chrom, loc, cds AS "CDS_Exons", u5 AND NOT cds AS "5'UTR_Exons", u3 AND NOT cds AS "3'UTR_Exons",
                   intron AND NOT (cds OR u5 OR u3) AS "Introns",
                   t1 AND NOT (cds OR u5 OR u3 OR intron) AS "TSS_up_1kb", t5 AND NOT (cds OR u5 OR u3 OR intron) AS "TSS_up_5kb",
                   t10 AND NOT (cds OR u5 OR u3 OR intron) AS "TSS_up_10kb", e1 AND NOT (cds OR u5 OR u3 OR intron) AS "TES_down_1kb",
                   e5 AND NOT (cds OR u5 OR u3 OR intron) AS "TES_down_5kb", e10 AND NOT (cds OR u5 OR u3 OR intron) AS "TES_down_10kb"
            FROM flags""",
        "longpure": """
            SELECT chrom, loc, grp FROM (UNPIVOT pure ON COLUMNS(* EXCLUDE (chrom, loc)) INTO NAME grp VALUE inside) WHERE inside""",
        "mids": "SELECT sample, read_name, chrom, b_start + (b_end - b_start + 1) // 2 AS loc FROM blocks WHERE hi = 1",
        "tags": """
            SELECT m.*, p.* EXCLUDE (chrom, loc),
                   ("5'UTR_Exons" AND "3'UTR_Exons") OR ("TSS_up_10kb" AND "TES_down_10kb") AS unclear
            FROM mids m LEFT JOIN pure p USING (chrom, loc)""",
        "taglong": """
            SELECT sample, grp, count_if(inside) AS tag_count FROM (
                UNPIVOT (SELECT * EXCLUDE (read_name, chrom, loc, unclear) REPLACE (
                    coalesce("CDS_Exons" AND NOT unclear, false) AS "CDS_Exons",
                    coalesce("5'UTR_Exons" AND NOT unclear, false) AS "5'UTR_Exons",
                    coalesce("3'UTR_Exons" AND NOT unclear, false) AS "3'UTR_Exons",
                    coalesce("Introns" AND NOT unclear, false) AS "Introns",
                    coalesce("TSS_up_1kb" AND NOT unclear, false) AS "TSS_up_1kb",
                    coalesce("TSS_up_5kb" AND NOT unclear, false) AS "TSS_up_5kb",
                    coalesce("TSS_up_10kb" AND NOT unclear, false) AS "TSS_up_10kb",
                    coalesce("TES_down_1kb" AND NOT unclear, false) AS "TES_down_1kb",
                    coalesce("TES_down_5kb" AND NOT unclear, false) AS "TES_down_5kb",
                    coalesce("TES_down_10kb" AND NOT unclear, false) AS "TES_down_10kb") FROM tags)
                ON COLUMNS(* EXCLUDE (sample)) INTO NAME grp VALUE inside)
            GROUP BY ALL""",
        "tagtotals": """
            SELECT sample, count(DISTINCT read_name) AS total_reads, count(*) AS total_tags,
                   count_if("CDS_Exons" IS NOT NULL AND NOT unclear) AS total_assigned_tags
            FROM tags GROUP BY sample""",
    }


#: Interval joins and what is made of them: filters of a query must not be moved into them, which turns their joins round.
COMPUTED_ONCE = {"bbins", "gbins", "ebins", "tx", "ex", "assigned", "odd", "oddblocks", "oddtx", "oddex"}


def build(final: str, mixed: bool = False, copies: bool = False, extra: dict[str, str] | None = None) -> str:
    """``final`` with the common table expressions it needs in dependency order."""
    ctes = {**base_ctes(mixed, copies), **(extra or {})}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in ctes:
            if name not in ordered and re.search(rf"\b{name}\b", sql) and ctes[name] is not sql:
                visit(ctes[name])
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    if not ordered:
        return final
    held = {n: " MATERIALIZED" if n in COMPUTED_ONCE else "" for n in ordered}
    return "WITH " + ",\n".join(f"{n} AS{held[n]} ({ctes[n]})" for n in ordered) + "\n" + final


def status_of(n: str) -> str:
    return f"CASE {n} WHEN 0 THEN 'Unassigned_NoFeatures' WHEN 1 THEN 'Assigned' ELSE 'Unassigned_Ambiguity' END"


PERCELL = """
    SELECT sample, barcode, sum(n) AS counts, count(*) AS genes, count_if(pk % 40 <> 0) AS nuclear,
           count_if(pk % 40 = 0) AS mito, sum(CASE WHEN pk % 40 = 0 THEN n ELSE 0 END) AS mito_counts
    FROM counts JOIN genes USING (gene_id) JOIN cells USING (sample, barcode) WHERE is_single_cell GROUP BY ALL"""

METRIC_SELECT = """
    coalesce(k.num_cells, 0) AS num_cells,
    CASE WHEN k.num_cells > 0 THEN r.raw_reads / k.num_cells ELSE 0 END AS raw_reads_per_cell,
    coalesce(k.mc, 0) AS mean_total_counts_per_cell, coalesce(k.dc, 0) AS median_total_reads_per_cell,
    coalesce(k.mg, 0) AS mean_genes_detected_per_cell, coalesce(k.dg, 0) AS median_genes_detected_per_cell,
    coalesce(k.mn, 0) AS mean_nuclear_genes_detected_per_cell, coalesce(k.dn, 0) AS median_nuclear_genes_detected_per_cell,
    coalesce(k.mm, 0) AS mean_mito_genes_detected_per_cell, coalesce(k.dm, 0) AS median_mito_genes_detected_per_cell,
    coalesce(k.pm, 0) AS percentage_counts_from_mito,
    CAST(coalesce(k.uniq, 0) AS BIGINT) AS num_unique_genes_detected_across_sample,
    CAST(coalesce(k.tot, 0) AS BIGINT) AS total_genes_detected_across_sample"""

CELL_AGGS = """
    count(*) AS num_cells, CAST(sum(counts) AS DOUBLE) / count(*) AS mc, floor(median(counts)) AS dc,
    CAST(sum(genes) AS DOUBLE) / count(*) AS mg, floor(median(genes)) AS dg,
    CAST(sum(nuclear) AS DOUBLE) / count(*) AS mn, floor(median(nuclear)) AS dn,
    CAST(sum(mito) AS DOUBLE) / count(*) AS mm, floor(median(mito)) AS dm,
    CASE WHEN sum(counts) > 0 THEN CAST(sum(mito_counts) AS DOUBLE) / CAST(sum(counts) AS DOUBLE) * 100 ELSE 0 END AS pm"""

SINGLE_STATS = {
    "percell": PERCELL,
    "uniq": """
        SELECT sample, count(DISTINCT gene_id) AS uniq FROM counts JOIN cells USING (sample, barcode)
        WHERE is_single_cell GROUP BY sample""",
    "kstats": f"SELECT p.sample, u.uniq, sum(genes) AS tot, {CELL_AGGS} FROM percell p JOIN uniq u USING (sample) GROUP BY ALL",
    "cellstats": f"SELECT r.sample, r.raw_reads AS raw, {METRIC_SELECT} FROM rawreads r LEFT JOIN kstats k USING (sample)",
}

MIXED_STATS = {
    "sc": """
        SELECT c.sample, c.barcode, c.gene_id, c.n, g.pk,
               CASE WHEN is_hsap_cell THEN 'Hsap' ELSE 'Mmus' END AS sp,
               starts_with(gene_name, CASE WHEN is_hsap_cell THEN 'GRCh38_' ELSE 'GRCm39_' END) AS own,
               g.chrom = CASE WHEN is_hsap_cell THEN 'GRCh38_MT' ELSE 'GRCm39_MT' END AS mt
        FROM counts c JOIN genes g USING (gene_id) JOIN cells2 k ON k.sample = c.sample AND k.barcode = c.barcode
        WHERE k.is_single_cell""",
    "percell": """
        SELECT sample, barcode, sp AS label, sum(CASE WHEN own THEN n ELSE 0 END) AS counts, count_if(own) AS genes,
               count_if(own AND NOT mt) AS nuclear, count_if(own AND mt) AS mito,
               sum(CASE WHEN own AND mt THEN n ELSE 0 END) AS mito_counts, count(*) AS every
        FROM sc GROUP BY ALL""",
    "labelled": "SELECT * FROM percell UNION ALL SELECT * REPLACE ('total' AS label) FROM percell",
    "uniq": """
        SELECT sample, sp AS label, count(DISTINCT gene_id) AS uniq FROM sc WHERE own GROUP BY ALL
        UNION ALL SELECT sample, 'total', count(DISTINCT gene_id) FROM sc GROUP BY ALL""",
    "kstats": f"""
        SELECT l.sample, l.label, u.uniq, CASE WHEN any_value(l.label) = 'total' THEN sum(every) ELSE sum(genes) END AS tot, {CELL_AGGS}
        FROM labelled l LEFT JOIN uniq u USING (sample, label) GROUP BY ALL""",
    "cellstats": f"""
        SELECT r.sample, r.label, {METRIC_SELECT}
        FROM (SELECT sample, raw_reads, unnest(['total', 'Hsap', 'Mmus']) AS label FROM rawreads) r
        LEFT JOIN kstats k ON k.sample = r.sample AND k.label = r.label""",
}

CATEGORIZED = """
    SELECT r.sample, r.raw_reads, coalesce(i, 0) AS reads_in_cells, coalesce(o, 0) AS reads_out_of_cells,
           r.raw_reads - coalesce(i, 0) - coalesce(o, 0) AS unusable_reads
    FROM rawreads r LEFT JOIN (
        SELECT a.sample, count_if(c.barcode IS NOT NULL) AS i, count_if(c.barcode IS NULL) AS o
        FROM (SELECT sample, nullif(regexp_extract(read_name, '_([ACGTN]{{13}})_', 1), '') AS bc FROM alignments WHERE flag < 256) a
        LEFT JOIN (SELECT * FROM {cells} WHERE is_single_cell) c ON c.sample = a.sample AND c.barcode = a.bc
        WHERE bc IS NOT NULL GROUP BY a.sample) x USING (sample)"""

READ_ROWS = [
    ("reads_pre_qc", "raw_reads"), ("barcode_exact_match", "barcode_direct_match"),
    ("barcode_corrected", "barcode_corrected"), ("barcode_failed", "barcode_failed"),
    ("barcode_valid_total", "post_barcode_reads_retained"), ("sss_too_short", "too_short_after_sss"),
    ("sss_retained", "post_sss_trim_reads_retained"), ("polyx_trimmed", "polyx_trimmed_terminal"),
    ("polyx_too_short", "polyx_too_short_after_trim"), ("polyx_retained", "post_polyx_trim_reads_retained"),
    ("quality_failed", "low_quality_reads"), ("quality_retained", "post_quality_filter_reads_retained"),
    ("n_base_failed", "too_many_n_reads"), ("n_base_retained", "post_n_filter_reads_retained"),
    ("polya_trimmed", "polya_trimmed_internal"), ("polya_too_short", "polya_too_short_after_trim"),
    ("polya_retained", "post_polya_trim_reads_retained"), ("reads_post_qc", "reads_output"),
]
READ_RATES = [
    ("valid_barcode_reads_perc", "post_barcode_reads_retained / raw_reads * 100"),
    ("reads_post_qc_perc", "reads_output / post_barcode_reads_retained * 100"),
    ("mean_read_length", "mean_read_length_post_QC"),
    ("rna_q30_rate", "R1_output_Q30_rate * 100"), ("barcode_q30_rate", "R2_barcode_Q30_rate * 100"),
]


def rows_sql(table: str, items: list[tuple[str, str]], integral: bool, classification: str) -> str:
    return " UNION ALL ".join(
        f"SELECT sample, '{n}' AS variable_name, coalesce(CAST({e} AS DOUBLE), 0) AS value, {str(integral).lower()} AS is_integral, "
        f"'{classification}' AS classification FROM {table}"
        for n, e in items
    )


READ_LONG = (
    rows_sql("cascade0", READ_ROWS, True, "Read QC") + " UNION ALL " + rows_sql("cascade0", READ_RATES, False, "Read QC")
)
FULL_READ_LONG = READ_LONG.replace("FROM cascade0", "FROM samples LEFT JOIN cascade0 USING (sample)")

METRICS13 = [
    "num_cells", "raw_reads_per_cell", "mean_total_counts_per_cell", "median_total_reads_per_cell",
    "mean_genes_detected_per_cell", "median_genes_detected_per_cell", "mean_nuclear_genes_detected_per_cell",
    "median_nuclear_genes_detected_per_cell", "mean_mito_genes_detected_per_cell", "median_mito_genes_detected_per_cell",
    "percentage_counts_from_mito", "num_unique_genes_detected_across_sample", "total_genes_detected_across_sample",
]


def is_whole(metric: str) -> bool:
    return metric.startswith("median") or metric == "num_cells" or metric.endswith("across_sample")


def cell_rows(mixed: bool) -> str:
    out = []
    for m in METRICS13:
        whole = str(is_whole(m)).lower()
        if mixed:
            out.append(f"SELECT sample, '{m}_' || label, CAST({m} AS DOUBLE), {whole}, '{m}' FROM cellstats")
        else:
            out.append(f"SELECT sample, '{m}', CAST({m} AS DOUBLE), {whole}, 'Cell metrics' FROM cellstats")
    return " UNION ALL ".join(out)


def distribution_ctes(prefix: str, source: str) -> dict[str, str]:
    """Distribution percent of one alignment set, under prefixed names."""
    base = base_ctes(False, False)
    blocks = base["blocks"].replace("FROM alignments", f"FROM {source}")
    mids = "SELECT sample, read_name, chrom, b_start + (b_end - b_start + 1) // 2 AS loc FROM " + f"{prefix}blocks"
    if source == "alignments":
        mids += " WHERE hi = 1"
    else:
        # a resolved secondary hit keeps its secondary flag
        blocks = blocks.replace(f"FROM {source}", f"FROM (SELECT * FROM {source} WHERE flag < 256)")
        blocks = blocks.replace("WHERE flag < 256) WHERE spliced", "WHERE flag < 256 AND spliced)")
    return {
        f"{prefix}blocks": blocks,
        f"{prefix}mids": mids,
        f"{prefix}tags": base["tags"].replace("FROM mids", f"FROM {prefix}mids"),
        f"{prefix}taglong": base["taglong"].replace("FROM tags", f"FROM {prefix}tags"),
        f"{prefix}tagtotals": base["tagtotals"].replace("FROM tags", f"FROM {prefix}tags"),
        f"{prefix}share": PERCENT.replace("taglong", f"{prefix}taglong").replace("tagtotals", f"{prefix}tagtotals"),
    }


PERCENT = """
    SELECT sample, grp, tag_count,
           CASE WHEN tag_count <> 0 THEN round(CAST(tag_count AS DOUBLE) / total_tags * 100, 2) ELSE 0 END AS perc
    FROM (
        SELECT sample, grp, tag_count FROM taglong
        WHERE grp NOT IN ('TSS_up_1kb', 'TSS_up_5kb', 'TES_down_1kb', 'TES_down_5kb')
        UNION ALL
        SELECT sample, 'Intergenic', any_value(total_tags) - sum(tag_count) FROM taglong JOIN tagtotals USING (sample)
        WHERE grp NOT IN ('TSS_up_1kb', 'TSS_up_5kb', 'TES_down_1kb', 'TES_down_5kb') GROUP BY sample
    ) JOIN tagtotals USING (sample)"""

GROUP_LIST = "['CDS_Exons', '5''UTR_Exons', '3''UTR_Exons', 'Introns', 'TSS_up_10kb', 'TES_down_10kb', 'Intergenic']"


def stage_rows(prefix: str, classification: str) -> str:
    grid = f"(SELECT sample, unnest({GROUP_LIST}) AS grp FROM samples)"
    return f"""
        SELECT sample, 'Total Tags', CAST(coalesce(total_tags, 0) AS DOUBLE), true, '{classification}'
        FROM samples LEFT JOIN {prefix}tagtotals USING (sample)
        UNION ALL SELECT sample, grp, CAST(coalesce(tag_count, 0) AS DOUBLE), true, '{classification}'
        FROM {grid} LEFT JOIN {prefix}share USING (sample, grp)
        UNION ALL SELECT sample, grp || '_perc', coalesce(perc, 0), false, '{classification}'
        FROM {grid} LEFT JOIN {prefix}share USING (sample, grp)"""


def metrics_long(mixed: bool, digits: int | None = 6) -> str:
    cells = "cells2" if mixed else "cells"
    extra = {
        **(MIXED_STATS if mixed else SINGLE_STATS),
        "categorized": CATEGORIZED.format(cells=cells),
        "inout": f"""
            SELECT sample, coalesce(i, 0) AS i, coalesce(o, 0) AS o FROM samples LEFT JOIN (
                SELECT sample, sum(CASE WHEN is_single_cell THEN total_counts ELSE 0 END) AS i,
                       sum(CASE WHEN NOT is_single_cell THEN total_counts ELSE 0 END) AS o FROM {cells} GROUP BY sample)
            USING (sample)""",
        "saturation": """
            SELECT s.sample, coalesce(b, 0) AS b, coalesce(d, 0) AS d FROM samples s
            LEFT JOIN (SELECT sample, count(*) AS b FROM annotated GROUP BY sample) USING (sample)
            LEFT JOIN (SELECT sample, count(*) AS d FROM deduped GROUP BY sample) USING (sample)""",
        **distribution_ctes("raw_", "alignments"),
        **distribution_ctes("ann_", "annotated"),
    }
    parts = [
        FULL_READ_LONG,
        rows_sql("categorized", [(c, c) for c in ("reads_in_cells", "reads_out_of_cells", "unusable_reads")], True, "Read QC"),
        rows_sql("inout", [("counts_in_cells", "i"), ("counts_out_of_cells", "o")], True, "Cell metrics"),
        cell_rows(mixed),
        rows_sql("saturation", [("reads_before_deduplication", "b"), ("reads_after_deduplication", "d")], True, "Deduplication"),
        rows_sql("saturation", [("sequencing_saturation", "CASE WHEN b > 0 THEN (1 - d / b) * 100 ELSE 0 END")], False, "Deduplication"),
        stage_rows("raw_", "Post read QC alignment"),
        stage_rows("ann_", "Annotated reads alignment"),
    ]
    if mixed:
        extra["mstats"] = """
            SELECT sample, count_if(is_called_cell) AS c, count_if(is_called_cell) - count_if(is_single_cell) AS m
            FROM samples LEFT JOIN cells2 USING (sample) GROUP BY sample"""
        parts.append(rows_sql("mstats", [("num_raw_cells_total", "c")], True, "num_raw_cells"))
        parts.append(rows_sql("mstats", [("num_multiplet_cells_total", "m")], True, "num_multiplet_cells"))
    body = " UNION ALL ".join(parts)
    return build(
        f"SELECT sample, variable_name, {'value' if digits is None else f'round(value, {digits})'} AS value, is_integral, "
        f"classification FROM ({body})", mixed, extra=extra
    )


STEPS = [
    ("Input", "raw_reads"), ("Barcode Validation", "post_barcode_reads_retained"),
    ("SSS Trimming", "post_sss_trim_reads_retained"), ("PolyX Trimming", "post_polyx_trim_reads_retained"),
    ("Quality Filtering", "post_quality_filter_reads_retained"), ("N-Base Filtering", "post_n_filter_reads_retained"),
    ("PolyA Trimming", "post_polya_trim_reads_retained"),
]
PROPORTIONS = " UNION ALL ".join(
    f"SELECT sample, {i} AS ord, '{s}' AS step, {c} AS reads, {c} / raw_reads AS proportion FROM cascade0"
    for i, (s, c) in enumerate(STEPS)
)
BARS = [
    ("Input", "Input reads", "raw_reads", "input"), ("Barcode Validation", "Exact match", "barcode_direct_match", "retained"),
    ("Barcode Validation", "Corrected", "barcode_corrected", "retained"), ("Barcode Validation", "Failed", "barcode_failed", "lost"),
    ("SSS Trimming", "Retained", "post_sss_trim_reads_retained", "retained"), ("SSS Trimming", "Too short", "too_short_after_sss", "lost"),
    ("PolyX Trimming", "Retained", "post_polyx_trim_reads_retained", "retained"),
    ("PolyX Trimming", "Too short", "polyx_too_short_after_trim", "lost"),
    ("Quality Filtering", "Retained", "post_quality_filter_reads_retained", "retained"),
    ("Quality Filtering", "Failed", "low_quality_reads", "lost"), ("N-Base Filtering", "Retained", "post_n_filter_reads_retained", "retained"),
    ("N-Base Filtering", "Excessive Ns", "too_many_n_reads", "lost"), ("PolyA Trimming", "Retained", "post_polya_trim_reads_retained", "retained"),
    ("PolyA Trimming", "Too short", "polya_too_short_after_trim", "lost"),
]
KEYS = {
    **SINGLE_STATS,
    # the report is over samples that have reads
    "keyrows": """
        SELECT sample, 'reads_pre_qc' AS variable_name, CAST(raw AS DOUBLE) AS value FROM cellstats WHERE raw > 0
        UNION ALL SELECT sample, 'num_cells', num_cells FROM cellstats WHERE raw > 0
        UNION ALL SELECT sample, 'raw_reads_per_cell', raw_reads_per_cell FROM cellstats WHERE raw > 0
        UNION ALL SELECT sample, 'median_genes_detected_per_cell', median_genes_detected_per_cell FROM cellstats WHERE raw > 0""",
}
GENE_USE = {
    "used": """
        SELECT s.sample, g.gene_id, g.gene_name, g.pk, u.gene_id IS NOT NULL AS seen
        FROM (SELECT DISTINCT sample FROM lines) s CROSS JOIN genes g
        LEFT JOIN (SELECT DISTINCT sample, gene_id FROM counts) u ON u.sample = s.sample AND u.gene_id = g.gene_id""",
    "gindex": """
        SELECT *, row_number() OVER (PARTITION BY sample ORDER BY NOT seen, CASE WHEN seen THEN gene_id END, pk) AS gene_index
        FROM used""",
    "bindex": "SELECT sample, barcode, row_number() OVER (PARTITION BY sample ORDER BY barcode) AS barcode_index FROM totals",
}

EARLIER = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
COMPRESSED = """
    SELECT sample, 'rows' AS axis, barcode_index AS major, gene_index AS minor, n,
           row_number() OVER (PARTITION BY sample ORDER BY barcode_index, gene_index) - 1 AS place
    FROM counts JOIN gindex USING (sample, gene_id) JOIN bindex USING (sample, barcode)
    UNION ALL SELECT sample, 'columns', gene_index, barcode_index, n,
           row_number() OVER (PARTITION BY sample ORDER BY gene_index, barcode_index) - 1
    FROM counts JOIN gindex USING (sample, gene_id) JOIN bindex USING (sample, barcode)"""

ORACLE_SQL: dict[str, str] = {
    "hamming_variants": build("SELECT barcode, variant, position FROM variants"),
    "curated_corrections": build("SELECT variant, barcode FROM safe"),
    "correction_list": build(
        "SELECT w.row_no, w.barcode, coalesce(string_agg(variant, ',' ORDER BY position, rank), '') AS variants "
        "FROM whitelist w LEFT JOIN safe USING (barcode) GROUP BY ALL"
    ),
    "collisions": build(
        "SELECT variant, count(*) OVER (PARTITION BY variant) AS origin_count, barcode AS origin FROM variants "
        "QUALIFY count(*) OVER (PARTITION BY variant) > 1"
    ),
    "collision_stats": build(
        "SELECT (SELECT count(*) FROM whitelist) AS total_barcodes, "
        "(SELECT count(DISTINCT barcode) FROM safe) AS barcodes_with_corrections, "
        "(SELECT count(*) FROM whitelist WHERE barcode NOT IN (SELECT barcode FROM safe)) AS barcodes_without_corrections, "
        "(SELECT count(*) FROM (SELECT variant FROM variants GROUP BY variant HAVING count(*) > 1)) AS total_variants_removed, "
        "(SELECT count(*) FROM safe) AS total_safe_variants"
    ),
    "last_correction": build(
        "SELECT variant, arg_max(barcode, row_no) AS barcode FROM variants JOIN whitelist USING (barcode) GROUP BY variant"
    ),
    "extract_barcode": build("SELECT sample, header, CASE WHEN length(r2_seq) >= 13 THEN left(r2_seq, 13) END AS observed FROM reads"),
    "match_barcodes": build("SELECT sample, header, observed, barcode, barcode_status FROM status"),
    "tag_read_name": build(
        "SELECT sample, '@' || read_name || '_' || barcode || '_ 1:N:0' AS header FROM matched WHERE barcode IS NOT NULL"
    ),
    "parse_barcode": build(
        "SELECT sample, hi, read_name, regexp_extract(read_name, '_([A-Z]+)_$', 1) AS counting, "
        "nullif(regexp_extract(read_name, '_([ACGTN]{13})_', 1), '') AS categorizing "
        "FROM (SELECT sample, hi, CASE WHEN nm = 1 THEN read_name || 'x' ELSE read_name END AS read_name FROM alignments)"
    ),
    "barcode_stats": build(
        "SELECT sample, count(*) AS total, count(barcode) AS passed, count_if(barcode IS NULL) AS failed, "
        "count_if(barcode_status = 'direct') AS direct_match, count_if(barcode_status = 'corrected') AS corrected "
        "FROM status GROUP BY sample"
    ),
    "trim_steps": build(
        "SELECT sample, header, r1_seq[9:] AS sss_trimmed, "
        "length(regexp_replace(r1_seq, '(A{10,}|C{10,}|G{10,}|T{10,})$', '')) AS polyx_keep, "
        "CASE WHEN regexp_matches(r1_seq, 'A{15,}|A{13,}CG') "
        "THEN length(regexp_extract(r1_seq, '^(.*?)(A{15,}|A{13,}CG)', 1)) + 1 ELSE 0 END AS polya_start, "
        "list_sum(list_transform(string_split(r1_qual, ''), lambda c: ascii(c) - 33)) < 15 * length(r1_qual) "
        "OR length(regexp_replace(r1_qual, '[^!-/]', '', 'g')) > 0.4 * length(r1_qual) AS low_quality, "
        "length(regexp_replace(r1_seq, '[^N]', '', 'g')) AS n_bases, "
        "CAST(list_sum(list_transform(string_split(r1_qual, ''), lambda c: ascii(c) - 33)) AS BIGINT) AS phred_sum FROM reads"
    ),
    "qc_reads": build("SELECT sample, header, lost_at, out_seq, out_qual, polyx_trimmed, polya_trimmed FROM qc"),
    "qc_cascade": build("SELECT * FROM cascade0"),
    "derived_read_metrics": build(
        "SELECT sample, post_barcode_reads_retained / raw_reads * 100 AS valid_barcode_reads_perc, "
        "reads_output / post_barcode_reads_retained * 100 AS reads_post_qc_perc, R1_output_Q30_rate * 100 AS rna_q30_rate, "
        "R2_barcode_Q30_rate * 100 AS barcode_q30_rate FROM cascade0"
    ),
    "read_summary": build(
        "SELECT sample, kind, total_reads, q30_bases, q30_bases / bases AS q30_rate, gc / bases AS gc_content, "
        "bases / total_reads AS mean_length FROM (SELECT sample, kind, count(*) AS total_reads, "
        "CAST(sum(length(regexp_replace(qual, '[^?-~]', '', 'g'))) AS BIGINT) AS q30_bases, CAST(sum(length(seq)) AS DOUBLE) AS bases, "
        "CAST(sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) AS DOUBLE) AS gc FROM profiled GROUP BY ALL)"
    ),
    "quality_curve": build("SELECT sample, kind, position, CAST(quality_sum AS DOUBLE) / bases AS mean_quality FROM positions"),
    "gc_curve": build("SELECT sample, kind, position, gc / bases AS gc_fraction FROM positions"),
    "n_curve": build("SELECT sample, kind, position, n / bases AS n_fraction FROM positions"),
    "length_distribution": build("SELECT sample, kind, length(seq) AS length, count(*) AS reads FROM profiled GROUP BY ALL"),
    "qc_json_documents": build(
        "SELECT sample, kind, CASE WHEN kind = 'R1 Post-QC' THEN 'after' ELSE 'before' END AS part, total_reads, q30_bases, "
        "(SELECT round(CAST(quality_sum AS DOUBLE) / bases, 6) FROM positions p WHERE p.sample = s.sample AND p.kind = s.kind AND position = 1) AS first_quality, "
        "(SELECT round(gc / bases, 6) FROM positions p WHERE p.sample = s.sample AND p.kind = s.kind AND position = 2) AS second_gc "
        "FROM (SELECT sample, kind, count(*) AS total_reads, "
        "CAST(sum(length(regexp_replace(qual, '[^?-~]', '', 'g'))) AS BIGINT) AS q30_bases FROM profiled GROUP BY ALL) s"
    ),
    "features": build("SELECT gene_id, gene_name, chrom AS chromosome FROM genes"),
    "distinct_features": build("SELECT DISTINCT gene_id, gene_name, chrom AS chromosome FROM genes"),
    "annotate_genes": build(
        "SELECT gene_id, gene_name, chrom AS chromosome, chrom IN ('GRCh38_MT', 'GRCm39_MT') AS is_mito, "
        "chrom = 'GRCh38_MT' AS is_mito_hsap, chrom = 'GRCm39_MT' AS is_mito_mmus, "
        "starts_with(gene_name, 'GRCh38_') AS is_hsap, starts_with(gene_name, 'GRCm39_') AS is_mmus FROM genes",
        mixed=True,
    ),
    "gene_models": build(
        "SELECT 'T' || pk AS transcript_id, chrom, strand, g_start AS first_exon_start, g_start AS start, g_end AS \"end\", "
        "CASE WHEN pk % 2 = 0 THEN g_start + 30 ELSE g_start END AS cds_start, "
        "CASE WHEN pk % 2 = 0 THEN g_start + 569 ELSE g_end END AS cds_end, 3 AS exon_count, "
        "'150,150,130' AS block_sizes, '0,250,470' AS block_starts FROM genes"
    ),
    "region_bases": build("SELECT chrom, grp, count(*) AS bases FROM longpure GROUP BY ALL"),
    "overlap_join": build(
        "SELECT a.sample, a.read_name, a.hi, g.gene_id || '.3' AS gene_id, "
        "least(a.e, g.g_end) - greatest(a.pos, g.g_start) + 1 AS shared FROM "
        "(SELECT *, pos + CASE WHEN spliced THEN 139 ELSE 39 END AS e, CASE WHEN rev = 1 THEN '-' ELSE '+' END AS strand FROM alignments) a "
        "JOIN genes g USING (chrom, strand) WHERE a.pos <= g.g_end AND g.g_start <= a.e"
    ),
    "assign_transcripts": build(
        f"SELECT sample, read_name, hi, {status_of('tx_n')} AS xs, CASE WHEN tx_n = 1 THEN 1 END AS xn, tx_gene AS xt FROM assigned"
    ),
    "assign_odd_alignments": build(
        "SELECT sample, read_name, ['40M', '5S35M', '20M2D20M', '10M3I27M', '8=2X30M', '*'][kind + 1] AS cigar, "
        "CASE WHEN kind = 5 THEN 'Unassigned_Unmapped' ELSE " + status_of("coalesce(t.n, 0)") + " END AS tx_status, "
        "CASE WHEN t.n = 1 THEN t.g || '.3' END AS tx_gene, "
        "CASE WHEN kind = 5 THEN 'Unassigned_Unmapped' ELSE " + status_of("coalesce(x.n, 0)") + " END AS ex_status, "
        "CASE WHEN x.n = 1 THEN x.g || '.3' END AS ex_gene, "
        "CASE WHEN kind < 5 THEN CASE WHEN rev = 1 THEN pos + [40, 35, 42, 37, 40][kind + 1] - 1 "
        "WHEN kind = 1 THEN pos - 5 ELSE pos END END AS five_prime "
        "FROM odd LEFT JOIN oddtx t USING (id) LEFT JOIN oddex x USING (id)",
        extra={
            "odd": "SELECT *, row_number() OVER () AS id FROM (SELECT *, pos % 6 AS kind, "
            "unnest(range(CASE WHEN pos % 5 = 0 THEN 2 ELSE 1 END)) AS copy FROM alignments)",
            "oddblocks": "SELECT id, chrom, strand, b_start, b_end, unnest(range(b_start // 1000, b_end // 1000 + 1)) AS bin FROM ("
            "SELECT id, chrom, CASE WHEN rev = 1 THEN '-' ELSE '+' END AS strand, pos + b[1] AS b_start, pos + b[2] AS b_end FROM ("
            "SELECT *, unnest([[[0, 39]], [[0, 34]], [[0, 19], [22, 41]], [[0, 9], [10, 36]], [[0, 7], [8, 9], [10, 39]], []][kind + 1]) AS b "
            "FROM odd))",
            **{
                name: f"SELECT id, count(*) AS n, min(gene_id) AS g FROM (SELECT id, gene_id, "
                f"sum(least(b_end, g_end) - greatest(b_start, g_start) + 1) AS shared FROM oddblocks JOIN {bins} USING (chrom, strand, bin) "
                f"WHERE b_start <= g_end AND g_start <= b_end AND greatest(b_start, g_start) // 1000 = bin GROUP BY ALL) "
                f"WHERE shared >= 20 GROUP BY ALL"
                for name, bins in (("oddtx", "gbins"), ("oddex", "ebins"))
            },
        },
    ),
    "assign_exons": build(
        f"SELECT sample, read_name, hi, {status_of('ex_n')} AS xs, CASE WHEN ex_n = 1 THEN 1 END AS xn, ex_gene AS xt FROM assigned"
    ),
    "assignment_summary": build(f"SELECT sample, {status_of('tx_n')} AS status, count(*) AS alignments FROM assigned GROUP BY ALL"),
    "gene_assignment_counts": build(
        "SELECT sample, tx_gene AS gene_id, count(*) AS alignments FROM assigned WHERE tx_n = 1 GROUP BY ALL"
    ),
    "filter_umr": build("SELECT sample, read_name, flag, chrom, pos FROM alignments WHERE nh = 1 AND nm <= 3"),
    "filter_multimapped": build("SELECT sample, read_name, hi, chrom, pos FROM alignments WHERE nh > 1 AND nm <= 3"),
    "umr_tie_break": build(
        "SELECT sample, read_name, ex_gene AS xt FROM assigned WHERE nh = 1 AND nm <= 3 AND tx_n > 1 AND ex_n = 1"
    ),
    "resolve_multimappers": build("SELECT sample, read_name, nh, hi, chrom, pos, xt FROM resolved1"),
    "multimapper_tie_break": build("SELECT sample, read_name, nh, hi, chrom, pos FROM open_reads"),
    "annotated_alignments": build("SELECT sample, read_name, nh, hi, chrom, pos, xt FROM annotated"),
    "count_alignments": build(
        "SELECT sample, count(*) AS annotated_alignments, count_if(rev = 1) AS antisense_alignments FROM annotated GROUP BY sample"
    ),
    "dedup_alignments": build("SELECT sample, chrom, pos, read_name, flag, mapq, xt FROM deduped", copies=True),
    "dedup_stats": build(
        "SELECT sample, b AS reads_before_deduplication, d AS reads_after_deduplication, "
        "round((1 - d / b) * 100, 6) AS sequencing_saturation "
        "FROM (SELECT sample, count(*) AS b FROM annotated GROUP BY sample) "
        "JOIN (SELECT sample, count(*) AS d FROM deduped GROUP BY sample) USING (sample)",
        copies=True,
    ),
    "events": build("SELECT sample, bc AS barcode, split_part(xt, '.', 1) AS gene_id FROM deduped"),
    "count_matrix": build("SELECT * FROM counts"),
    "named_counts": build(
        "SELECT sample, barcode, gene_id, n, gene_name, chrom AS chromosome FROM counts LEFT JOIN genes USING (gene_id)"
    ),
    "cell_totals": build("SELECT sample, barcode, total_counts, n_genes FROM totals"),
    "cell_totals_mixed": build("SELECT * FROM totals", mixed=True),
    "zero_genes": build("SELECT sample, gene_id, gene_name FROM used WHERE NOT seen", extra=GENE_USE),
    "index_genes": build("SELECT sample, gene_id, gene_index FROM gindex", extra=GENE_USE),
    "index_barcodes": build("SELECT * FROM bindex", extra=GENE_USE),
    "unique_gene_names": build(
        "SELECT sample, gene_id, CASE WHEN k = 1 THEN gene_name ELSE gene_name || '-' || (k - 1) END AS unique_name "
        "FROM (SELECT *, row_number() OVER (PARTITION BY sample, gene_name ORDER BY gene_index) AS k FROM gindex)",
        extra=GENE_USE,
    ),
    "matrix_entries": build(
        "SELECT sample, gene_index, barcode_index, n FROM counts JOIN gindex USING (sample, gene_id) JOIN bindex USING (sample, barcode)",
        extra=GENE_USE,
    ),
    "filtered_matrix": build(
        "SELECT c.* FROM counts c JOIN cells k ON k.sample = c.sample AND k.barcode = c.barcode WHERE k.is_single_cell"
    ),
    "density_curve": build("SELECT sample, i, round(x, 6) AS x, round(d, 6) AS d FROM curve"),
    "local_minima": build("SELECT sample, i, round(x, 6) AS x, round(d, 6) AS d FROM minima"),
    "derivatives": build(
        "SELECT sample, i, round(first_derivative, 4) AS first_derivative, round(second_derivative, 4) AS second_derivative FROM diffs"
    ),
    "inflections": build("SELECT sample, i, round(x, 6) AS x FROM turns", extra={"vals": """
        SELECT sample, 'all' AS species,
               CASE WHEN u < 800 THEN 60 + a + b + d ELSE 150 + a * a * a // 50 + b END AS c
        FROM (SELECT sample, (l_orderkey * 7919 + l_linenumber * 104729) % 1000 AS u, l_partkey * 31 % 101 AS a,
                     l_suppkey * 17 % 97 AS b, (l_orderkey * 13 + l_linenumber * 7) % 89 AS d FROM lines)"""}),
    "thresholds": build("SELECT sample, round(cutoff, 6) AS log_cutoff, threshold FROM limits"),
    "thresholds_manual": build(
        "SELECT sample, CASE WHEN sample = 'S0' THEN 2.4 ELSE round(cutoff, 6) END AS log_cutoff, "
        "CASE WHEN sample = 'S0' THEN 250 ELSE threshold END AS threshold FROM limits"
    ),
    "thresholds_mixed": build("SELECT * FROM limits2", mixed=True),
    "cells_single": build("SELECT sample, barcode, total_counts, n_genes, threshold, is_single_cell FROM cells"),
    "cells_mixed": build("SELECT * FROM cells2", mixed=True),
    "route_samples": build(
        "SELECT sample, coalesce(umr, 0) AS umr, coalesce(umr, 0) > 0 AS has_reads FROM samples LEFT JOIN "
        "(SELECT sample, count(*) AS umr FROM alignments WHERE nh = 1 AND nm <= 3 GROUP BY sample) USING (sample)"
    ),
    "categorize_reads": build("SELECT * FROM categorized", extra={"categorized": CATEGORIZED.format(cells="cells")}),
    "counts_in_out_cells": build(
        "SELECT sample, CAST(sum(CASE WHEN is_single_cell THEN total_counts ELSE 0 END) AS BIGINT) AS counts_in_cells, "
        "CAST(sum(CASE WHEN NOT is_single_cell THEN total_counts ELSE 0 END) AS BIGINT) AS counts_out_of_cells FROM cells GROUP BY sample"
    ),
    "cell_metrics_single": build("SELECT * EXCLUDE (raw) FROM cellstats", extra=SINGLE_STATS),
    "cell_metrics_mixed": build("SELECT * FROM cellstats", mixed=True, extra=MIXED_STATS),
    "multiplets": build(
        "SELECT sample, count_if(is_called_cell) AS num_raw_cells_total, "
        "count_if(is_called_cell) - count_if(is_single_cell) AS num_multiplet_cells_total FROM cells2 GROUP BY sample",
        mixed=True,
    ),
    "read_distribution": build(
        "SELECT sample, grp, coalesce(total_bases, 0) AS total_bases, tag_count, "
        "tag_count * 1000.0::DOUBLE / (coalesce(total_bases, 0) + 1) AS tags_per_kb "
        "FROM taglong LEFT JOIN (SELECT grp, count(*) AS total_bases FROM longpure GROUP BY grp) USING (grp)"
    ),
    "read_distribution_totals": build(
        "SELECT sample, coalesce(total_reads, 0) AS total_reads, coalesce(total_tags, 0) AS total_tags, "
        "coalesce(total_assigned_tags, 0) AS total_assigned_tags FROM samples LEFT JOIN tagtotals USING (sample)"
    ),
    "distribution_percent": build("SELECT * FROM share", extra={"share": PERCENT}),
    "metrics_long": metrics_long(False),
    "metrics_long_mixed": metrics_long(True),
    "metrics_pivot": build(
        "SELECT variable_name, classification, "
        + ", ".join(
            f"max(CASE WHEN sample = '{s}' THEN CASE WHEN is_integral THEN CAST(CAST(value AS BIGINT) AS VARCHAR) "
            f"ELSE printf('%.2f', value) END END) AS {s}"
            for s in ("S0", "S1", "S2", "S9")
        )
        + f" FROM ({metrics_long(False, None)}) GROUP BY ALL"
    ),
    "cascade_proportions": build(PROPORTIONS),
    "cascade_box": build(
        """SELECT view, ord, step, n, round(median, 6) AS median, round(mean, 6) AS mean, round(sd, 6) AS sd, round(q1, 6) AS q1,
        round(q3, 6) AS q3,
        round(least(q1, list_min(list_filter(vs, lambda v: v >= q1 - 1.5 * (q3 - q1)))), 6) AS lower_fence,
        round(greatest(q3, list_max(list_filter(vs, lambda v: v <= q3 + 1.5 * (q3 - q1)))), 6) AS upper_fence
        FROM (SELECT view, ord, step, n, mean, sd, vs, quant(0.25) AS q1, quant(0.5) AS median, quant(0.75) AS q3 FROM boxed)"""
        .replace("quant(0.25)", "QUANT:0.25").replace("quant(0.5)", "QUANT:0.5").replace("quant(0.75)", "QUANT:0.75")
        .replace("QUANT:0.25", "{Q1}").replace("QUANT:0.5", "{Q2}").replace("QUANT:0.75", "{Q3}")
        .format(
            **{
                k: (
                    f"(vs[CAST(floor(least(greatest(n * {p} + 0.5, 1), n)) AS INTEGER)] * "
                    f"(1 - (least(greatest(n * {p} + 0.5, 1), n) - floor(least(greatest(n * {p} + 0.5, 1), n)))) + "
                    f"vs[CAST(ceil(least(greatest(n * {p} + 0.5, 1), n)) AS INTEGER)] * "
                    f"(least(greatest(n * {p} + 0.5, 1), n) - floor(least(greatest(n * {p} + 0.5, 1), n))))"
                )
                for k, p in (("Q1", 0.25), ("Q2", 0.5), ("Q3", 0.75))
            }
        ),
        extra={
            "props": PROPORTIONS,
            "boxed": """
                SELECT view, ord, step, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS sd, list_sort(list(v)) AS vs FROM (
                    SELECT 'proportional' AS view, ord, step, proportion AS v FROM props
                    UNION ALL SELECT 'absolute', ord, step, CAST(reads AS DOUBLE) FROM props) GROUP BY ALL""",
        },
    ),
    "sample_steps": build(
        " UNION ALL ".join(
            f"SELECT sample, {i} AS ord, '{s}' AS step, '{b}' AS metric, '{k}' AS kind, {c} AS value, "
            f"round({c} / raw_reads * 100, 6) AS percent_of_input FROM cascade0"
            for i, (s, b, c, k) in enumerate(BARS)
        )
    ),
    "axis_ranges": build(
        "SELECT variable_name, round(greatest(min(value) - 2 * stddev_samp(value), 0), 6) AS y_min, "
        "round(max(value) + 2 * stddev_samp(value), 6) AS y_max FROM keyrows GROUP BY ALL",
        extra=KEYS,
    ),
    "metric_n": build("SELECT variable_name, count(value) AS n FROM keyrows GROUP BY ALL", extra=KEYS),
    "key_metric_labels": build(
        "SELECT sample, variable_name, CASE WHEN value >= 1000000 THEN printf('%.1f M', value / 1000000) "
        "WHEN value >= 1000 THEN printf('%.1f k', value / 1000) ELSE printf('%.1f', value) END AS label FROM keyrows",
        extra=KEYS,
    ),
    # formats
    "format_values": (
        "SELECT l_orderkey, l_linenumber, printf('%.2f', v) AS value_text, "
        "CASE WHEN w >= 1000000 THEN printf('%.1f M', w / 1000000) WHEN w >= 1000 THEN printf('%.1f k', w / 1000) "
        "ELSE printf('%.1f', w) END AS label, CAST(printf('%.2f', v) AS DOUBLE) AS rounded FROM (SELECT *, abs(v) * 997 AS w FROM ("
        "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN (l_orderkey % 4000) * 0.125::DOUBLE "
        "WHEN 1 THEN (l_orderkey % 977) * 0.005::DOUBLE WHEN 2 THEN (l_partkey % 5000) * 50::DOUBLE "
        "ELSE -1::DOUBLE * (l_suppkey % 999) / 8::DOUBLE END AS v FROM lineitem))"
    ),
    "gtf_lines": (
        "SELECT 'chr' || (p_partkey % 4) AS seqname, 'transcript' AS feature, CAST(p_partkey * 10 AS BIGINT) AS start, "
        "CAST(p_partkey * 10 + 99 AS BIGINT) AS \"end\", CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END AS strand, "
        "'gene_id \"G' || p_partkey || '\"; gene_name \"' || p_name || '\";' AS attributes, p_partkey AS row_no "
        "FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0"
    ),
    "sam_lines": build(
        "SELECT sample, read_name, flag, chrom, pos, mapq, CASE WHEN spliced THEN '20M100N20M' ELSE '40M' END AS cigar, "
        "'ACGT' AS seq, nh, hi, nm FROM alignments"
    ),
    "bed12_lines": build(
        "SELECT concat_ws(chr(9), chrom, g_start - 1, g_end, 'T' || pk, '0', strand, "
        "CASE WHEN pk % 2 = 0 THEN g_start + 29 ELSE g_start - 1 END, CASE WHEN pk % 2 = 0 THEN g_start + 569 ELSE g_end END, "
        "'0', '3', '150,150,130,', '0,250,470,') AS value FROM genes"
    ),
    "correction_lines": build("SELECT w.barcode, s.variant, w.row_no FROM whitelist w LEFT JOIN safe s USING (barcode)"),
    "collision_lines": build(
        "SELECT 0 AS part, concat_ws(chr(9), 'total_barcodes', (SELECT count(*) FROM whitelist)) AS value UNION ALL "
        "SELECT 1, concat_ws(chr(9), 'barcodes_with_corrections', (SELECT count(DISTINCT barcode) FROM safe)) UNION ALL "
        "SELECT 2, concat_ws(chr(9), 'barcodes_without_corrections', "
        "(SELECT count(*) FROM whitelist WHERE barcode NOT IN (SELECT barcode FROM safe))) UNION ALL "
        "SELECT 3, concat_ws(chr(9), 'total_variants_removed', "
        "(SELECT count(*) FROM (SELECT variant FROM variants GROUP BY variant HAVING count(*) > 1))) UNION ALL "
        "SELECT 4, concat_ws(chr(9), 'total_safe_variants', (SELECT count(*) FROM safe)) UNION ALL "
        "SELECT 5, concat_ws(chr(9), 'variant', 'origin_count', 'origins') UNION ALL "
        "SELECT 6, concat_ws(chr(9), variant, count(*), string_agg(barcode, ',' ORDER BY barcode)) "
        "FROM variants GROUP BY variant HAVING count(*) > 1"
    ),
    "fastq_lines": build(
        "SELECT sample, concat_ws(chr(10), '@' || read_name || '_' || barcode || '_ 1:N:0', out_seq, '+', out_qual) AS value "
        "FROM qc WHERE lost_at IS NULL"
    ),
    "rejected_fastq_lines": build(
        "SELECT sample, concat_ws(chr(10), header, r1_seq, '+', r1_qual) AS value, 'r1' AS mate FROM qc WHERE lost_at IS NOT NULL "
        "UNION ALL SELECT sample, concat_ws(chr(10), header, r2_seq, '+', r2_qual), 'r2' FROM qc WHERE lost_at IS NOT NULL"
    ),
    "matrix_lines": build(
        "SELECT sample, barcode_index AS c, gene_index AS g, concat_ws(' ', gene_index, barcode_index, n) AS value "
        "FROM counts JOIN gindex USING (sample, gene_id) JOIN bindex USING (sample, barcode) UNION ALL "
        "SELECT sample, unnest([-3, -2, -1]) AS c, 0 AS g, unnest(['%%MatrixMarket matrix coordinate integer general', '%', "
        "concat_ws(' ', (SELECT max(gene_index) FROM gindex x WHERE x.sample = s.sample), "
        "(SELECT max(barcode_index) FROM bindex x WHERE x.sample = s.sample), "
        "(SELECT count(*) FROM counts x WHERE x.sample = s.sample))]) FROM (SELECT DISTINCT sample FROM lines) s",
        extra=GENE_USE,
    ),
    "fastq_lanes": build(
        "SELECT sample, CAST(length(header) % 2 + 1 AS INTEGER) AS lane, header, r1_seq, r1_qual, r2_seq, r2_qual, "
        "row_number() OVER (PARTITION BY sample ORDER BY length(header) % 2, header) - 1 AS ord FROM reads"
    ),
    "file_line_ordinals": build(
        "SELECT barcode AS value, row_number() OVER (ORDER BY row_no % 3, row_no) - 1 AS row_no FROM whitelist"
    ),
    "matrix_files": build(
        "SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY barcode_index, gene_index) AS line, "
        "gene_index AS row, barcode_index AS col, n FROM counts JOIN gindex USING (sample, gene_id) "
        "JOIN bindex USING (sample, barcode) UNION ALL SELECT sample, 0, "
        "(SELECT max(gene_index) FROM gindex x WHERE x.sample = s.sample), "
        "(SELECT max(barcode_index) FROM bindex x WHERE x.sample = s.sample), "
        "(SELECT count(*) FROM counts x WHERE x.sample = s.sample) FROM (SELECT DISTINCT sample FROM lines) s",
        extra=GENE_USE,
    ),
    "sparse_pointers": build(
        f"SELECT sample, 'rows' AS axis, barcode_index AS major, stored, CAST(coalesce(sum(stored) OVER (PARTITION BY sample ORDER BY barcode_index {EARLIER}), 0) AS BIGINT) AS start "
        "FROM (SELECT sample, barcode_index, count(n) AS stored FROM bindex LEFT JOIN counts USING (sample, barcode) GROUP BY ALL) "
        f"UNION ALL SELECT sample, 'columns', gene_index, stored, CAST(coalesce(sum(stored) OVER (PARTITION BY sample ORDER BY gene_index {EARLIER}), 0) AS BIGINT) "
        "FROM (SELECT sample, gene_index, count(n) AS stored FROM gindex LEFT JOIN counts USING (sample, gene_id) GROUP BY ALL)",
        extra=GENE_USE,
    ),
    "sparse_entries": build(f"SELECT * FROM ({COMPRESSED})", extra=GENE_USE),
    "sparse_slice": build(
        f"SELECT * FROM ({COMPRESSED}) WHERE CASE axis WHEN 'rows' THEN major BETWEEN 20 AND 60 ELSE major BETWEEN 100 AND 300 END",
        extra=GENE_USE,
    ),
    "sam_scan": build(
        "SELECT sample, read_name, chrom, pos, nh, nm FROM alignments "
        "WHERE chrom IN ('chr1', 'chr3') AND pos < 60000 AND flag = 16 AND sample <> 'S2'"
    ),
    "sam_scan_all": build(
        "SELECT sample, read_name, flag, chrom, pos, mapq, CASE WHEN spliced THEN '20M100N20M' ELSE '40M' END AS cigar, "
        'nh, hi, nm, \'ACGT\' AS seq, \'IIII\' AS qual, NULL::INTEGER AS "as", NULL::VARCHAR AS xs, NULL::INTEGER AS xn, '
        "NULL::VARCHAR AS xt FROM alignments"
    ),
    "region_alignments": build(
        'SELECT sample, read_name, chrom, pos, nh, hi, pos + CASE WHEN spliced THEN 139 ELSE 39 END AS "end", '
        "CASE WHEN spliced THEN '20M100N20M' ELSE '40M' END AS cigar FROM alignments "
        "WHERE chrom = 'chr2' AND sample IN ('S0', 'S2') AND pos <= 45000 AND pos + CASE WHEN spliced THEN 139 ELSE 39 END >= 30000"
    ),
    "region_coverage": build(
        'SELECT sample, chrom, CAST(pos // 1000 AS BIGINT) AS "window", count(*) AS alignments FROM alignments GROUP BY ALL'
    ),
    "samplesheet_rows": (
        "SELECT 's' || (p_partkey % 40) AS sample, 'f1_' || p_partkey AS fastq_1, 'f2_' || p_partkey AS fastq_2, "
        "CASE WHEN p_partkey % 3 = 0 THEN 2.5::DOUBLE END AS manual_threshold, "
        "CAST(row_number() OVER (PARTITION BY p_partkey % 40 ORDER BY p_partkey) AS INTEGER) AS lane FROM part"
    ),
    "metric_csv_values": build(
        f"SELECT sample, variable_name, false AS has_exponent, true AS same, NOT is_integral AS has_point FROM ({READ_LONG})"
    ),
}
