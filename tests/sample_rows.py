"""Fixed sample rows (one record per line) used by the golden tests."""

# user id, ip, success or fail, epoch seconds
LOGINS = """
5402,83.149.11.115,success,1558430815
23064,66.249.3.15,fail,1558430826
5692,80.149.25.29,fail,155843082
7233,86.226.15.75,success,1558430832
5692,80.149.25.29,success,1558430840
29607,66.249.73.135,success,1558430841
1035,83.149.9.216,fail,1558430842
1035,83.149.9.216,fail,1558430843
1035,83.149.24.26,fail,1558430844
7328,193.114.45.13,success,1558430848
29607,66.249.73.135,success,1558430847
2133,50.16.19.13,success,1558430857
6745,66.249.73.185,success,1558430859
76456,110.136.166.128,success,1558430853
8345,46.105.14.53,success,1558430855
76456,110.136.166.128,success,1558430857
76456,110.136.166.128,success,1558430854
76456,110.136.166.128,fail,1558430859
76456,110.136.166.128,success,1558430861
3464,123.125.71.35,success,1558430860
76456,110.136.166.128,success,1558430865
65322,50.150.204.184,success,1558430866
23565,207.241.237.225,fail,1558430862
8455,200.49.190.101,success,1558430867
8455,200.49.190.100,success,1558430865
8455,200.49.190.101,success,1558430869
8455,200.49.190.101,success,1558430872
32031,66.249.73.185,success,1558430875
12018,66.249.73.135,success,1558430874
12018,66.249.73.135,success,1558430879
12018,66.249.73.135,success,1558430881
21419,67.214.178.190,success,1558430882
21419,67.214.178.190,success,1558430880
23565,207.241.237.220,success,1558430881
2386,46.105.14.53,success,1558430883
23565,207.241.237.227,fail,1558430884
83419,91.177.205.119,success,1558430881
83419,91.177.205.119,fail,1558430882
83419,91.177.205.119,fail,1558430881
83419,91.177.205.119,fail,1558430883
83419,91.177.205.119,success,1558430884
83419,91.177.205.119,success,1558430886
4325,26.249.73.15,success,1558430888
2123,207.241.237.228,success,1558430887
21083,207.241.237.101,success,1558430889
13490,87.169.99.232,success,1558430886
93765,209.85.238.199,success,1558430890
93765,209.85.238.199,success,1558430892
""".split()

# order id, create or pay, transaction (empty on create), epoch seconds
ORDERS = """
34729,create,,1558430842
34730,create,,1558430843
34729,pay,sd76f87d6,1558430844
34730,pay,3hu3k2432,1558430845
34731,create,,1558430846
34731,pay,35jue34we,1558430849
34732,create,,1558430852
34733,create,,1558430855
34734,create,,1558430859
34732,pay,32h3h4b4t,1558430861
34735,create,,1558430862
34734,pay,435kjb45d,1558430863
34733,pay,766lk5nk4,1558430864
34736,create,,1558430866
34737,create,,1558430868
34735,pay,5k432k4n,1558430869
34738,create,,1558430871
34739,create,,1558430874
34736,pay,435kjb45s,1558430875
34740,create,,1558430877
34741,create,,1558430882
34742,create,,1558430884
34743,create,,1558430885
34744,create,,1558430886
34745,create,,1558430889
34746,create,,1558430892
34747,create,,1558430893
34748,create,,1558430895
34746,pay,3243hr9h9,1558430895
34738,pay,43jhin3k4,1558430896
34745,pay,8xz09ddsaf,1558430896
34741,pay,88df0wn92,1558430896
34749,create,,1558430899
34747,pay,329d09f9f,1558430893
34743,pay,3hefw8jf,1558430900
34750,create,,1558430901
34737,pay,324jnd45s,1558430902
34751,create,,1558430902
34744,pay,499dfano2,1558430903
34752,create,,1558430905
34742,pay,435kjb4432,1558430906
34753,create,,1558430906
34739,pay,98x0f8asd,1558430907
34754,create,,1558430908
34755,create,,1558430911
34740,pay,392094j32,1558430913
34756,create,,1558430913
34753,pay,8c6vs8dd,1558430913
34757,create,,1558430915
34749,pay,324n0239,1558430916
34755,pay,8x0zvy8w3,1558430918
34758,create,,1558430921
34759,create,,1558430922
34752,pay,rnp435rk,1558430925
34760,create,,1558430926
34761,create,,1558430927
34762,create,,1558430933
34748,pay,809saf0ff,1558430934
34763,create,,1558430936
34764,create,,1558430938
34765,create,,1558430940
34751,pay,24309dsf,1558430941
34750,pay,sad90df3,1558430941
34761,pay,902dsqw45,1558430943
34766,create,,1558430944
34767,create,,1558430949
34768,pay,88snrn932,1558430950
34759,pay,9203kmfn,1558430950
34754,pay,3245nbo7,1558430950
34758,pay,32499fd9w,1558430950
34760,pay,390mf2398,1558430960
34757,pay,d8938034,1558430962
34762,pay,84309dw31r,1558430983
34763,pay,sddf9809ew,1558431068
34764,pay,832jksmd9,1558431079
34765,pay,m23sare32e,1558431082
34766,pay,92nr903msa,1558431095
34756,pay,9032n4fd2,1558431951
34767,pay,sdafen9932,1558432021
""".split()

# transaction, channel, epoch seconds
RECEIPTS = """
ewr342as4,wechat,1558430845
sd76f87d6,wechat,1558430847
3hu3k2432,alipay,1558430848
8fdsfae83,alipay,1558430850
32h3h4b4t,wechat,1558430852
766lk5nk4,wechat,1558430855
435kjb45d,alipay,1558430859
5k432k4n,wechat,1558430862
435kjb45s,wechat,1558430866
324jnd45s,wechat,1558430868
43jhin3k4,wechat,1558430871
98x0f8asd,alipay,1558430874
392094j32,wechat,1558430877
88df0wn92,alipay,1558430882
435kjb4432,alipay,1558430884
3hefw8jf,alipay,1558430885
499dfano2,wechat,1558430886
8xz09ddsaf,wechat,1558430889
3243hr9h9,wechat,1558430892
329d09f9f,alipay,1558430893
809saf0ff,wechat,1558430895
324n0239,wechat,1558430899
sad90df3,alipay,1558430901
24309dsf,alipay,1558430902
rnp435rk,wechat,1558430905
8c6vs8dd,wechat,1558430906
3245nbo7,alipay,1558430908
8x0zvy8w3,alipay,1558430911
9032n4fd2,wechat,1558430913
d8938034,wechat,1558430915
32499fd9w,alipay,1558430921
9203kmfn,alipay,1558430922
390mf2398,alipay,1558430926
902dsqw45,wechat,1558430927
84309dw31r,alipay,1558430933
sddf9809ew,alipay,1558430936
832jksmd9,wechat,1558430938
m23sare32e,wechat,1558430940
92nr903msa,wechat,1558430944
sdafen9932,alipay,1558430949
""".split()

# user, epoch seconds, event
CART = """
user1,1547718210,add
user1,1547718215,order
user1,1547718220,pay
user1,1547718225,add
user1,1547718230,order
user2,1547718235,add
user2,1547718240,order
user2,1547718245,pay
user2,1547718250,add
user2,1547718255,order
""".split()
