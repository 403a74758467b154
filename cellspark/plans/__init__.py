"""Plan building blocks for scale, the end-to-end pipeline and the test-table bridge."""
