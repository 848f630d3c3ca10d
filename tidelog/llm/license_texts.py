"""Whole licences as digests of their canonical form, with a word that all spellings of the text have.

Made with ``license_digest.digest`` from Debian's ``/usr/share/common-licenses``, and the
Boost licence and the Unlicense as packages ship them. BSD: the Regents' text, with the
copyright holder or owner in their place, with and without the third clause, numbers and
title. Apache-2.0, GPL-2.0, GPL-3.0 and LGPL-2.1 also without the appendix after the terms.
"""

#: License, digest, marker.
DIGESTS: tuple[tuple[str, str, str], ...] = (
    ("Apache-2.0", "0818416e55cf8492558c7bef669d279ad3d55c36c93d1f26cfc7bbf175d07c26", "appropriateness"),
    ("Apache-2.0", "6fd0c54a297931a11c5e9c3d369524d9df1aa1964e9e93ca0c40f20a1d42503d", "appropriateness"),
    ("Apache-2.0", "a1e4d583bb49dab27f66204c07e99e7991e0a84accca050cb1a3f897c0e0f51b", "appropriateness"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702", "merchantibility"),
    ("BSD-2-Clause", "107f8ba0af742645bf7864695e36616fbcaa19b8c1ebb01f30fac7dd4011913a", "merchantability"),
    ("BSD-2-Clause", "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2", "merchantability"),
    ("BSD-2-Clause", "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2", "merchantability"),
    ("BSD-2-Clause", "90d48255144eaa2455264d0af9ef20ac2d4b728bc2fa878ea3059038a0bba60b", "merchantability"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74", "merchantability"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30", "merchantability"),
    ("BSD-2-Clause", "b7a2aed1fa065cd606a9a031c76bbda14762c5ee42dc79ffd671ad56ff168604", "merchantability"),
    ("BSD-2-Clause", "f70e318812c2186c966e06dbe61de79ef179650c6b6b0763f3571effcefd5ab9", "merchantability"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651", "merchantability"),
    ("BSD-3-Clause", "4079d1a9108ca437dd29ac26e1f73dbf7bb3b61ba3392438373db7018cf188c3", "merchantability"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa", "merchantability"),
    ("BSD-3-Clause", "69fcedb70fd1930cb5d773bb71eb605a3aec6362c678302194666d60ca468f71", "merchantability"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2", "merchantability"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15", "merchantability"),
    ("BSD-3-Clause", "d0a339eb5454123c6a1f2696aace557e0561866f3fe33b93ffad58ecfcab7060", "merchantability"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af", "merchantability"),
    ("BSL-1.0", "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded", "merchantability"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", "implementations"),
    ("GFDL-1.2", "d0d142139ba117e0fbb63d29df37776bc9c765c015720dc0ed43bceea6416494", "straightforwardly"),
    ("GFDL-1.3", "2cdb48855af1603586f28b20f0095e588a4bd77ee484d2c3b89bc3b1f0b61da5", "straightforwardly"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224", "responsibilities"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808", "responsibilities"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34", "responsibilities"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", "responsibilities"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191", "misrepresentation"),
    ("GPL-3.0", "24cd241e223e73eb1af195b9e4c0baf03a79bbbb39987eca0e347c1e490442aa", "misrepresentation"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636", "misrepresentation"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", "straightforwardly"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4", "straightforwardly"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", "straightforwardly"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df", "straightforwardly"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", "distinguishing"),
    ("MPL-1.1", "e4d7347f1855f056365c08ad8030307f5cda3d38c9658d4f4db9a7c0aaac6c53", "notwithstanding"),
    ("MPL-2.0", "b59ad31436b35a95a00cff48e84c1f014339f59fac784c1935fc6f7dc34abf70", "responsibilities"),
    ("Unlicense", "248c77414369ce4b842760d0241cb8184f0805a4354f498a6fb7f7b027ee767e", "merchantability"),
)
