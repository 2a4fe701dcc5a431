"""Column functions and the pure Python kernels behind the few Arrow UDFs."""
