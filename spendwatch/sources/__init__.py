from spendwatch.sources.readers import read_table, rate_card_scan, write_json_lines

__all__ = ["read_table", "rate_card_scan", "write_json_lines"]
