"""Writers that render DataFrames as annotation files or report files."""
