from tidemark.functions.columns import format_mm_ss, parse_mixed_date, pick_nth_field

__all__ = ["format_mm_ss", "parse_mixed_date", "pick_nth_field"]
