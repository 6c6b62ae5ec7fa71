"""Layer contracts and the checks made before a plan is built."""
