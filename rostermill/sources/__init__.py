"""Scans: file listing, fixed-width reports, workbook sheets."""
