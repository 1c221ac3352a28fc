"""File formats."""

from .files import read_alignments, read_capture, read_capture_runs, read_clusters, read_fasta, read_gfa_links, write_capture, write_fasta, write_report_tsv, write_stats_csv
from .pieces import read_fasta_pieces

__all__ = ["read_alignments", "read_capture", "read_capture_runs", "read_clusters", "read_fasta", "read_fasta_pieces", "read_gfa_links", "write_capture", "write_fasta", "write_report_tsv", "write_stats_csv"]
