"""DataFrame-to-DataFrame operators. They are lazy, except that the joins with
control and lookup tables measure the smaller side first."""
